"""Personal data replaced by keyed, type-consistent surrogates, with DataFrame expressions only.

1. One pattern finds all kinds of entities, in one scan whose result is a written table. A text is cut at its matches;
   only texts with one go further.
2. Mention lists are reduced to distinct ones (copies of a text share theirs), then to distinct entities. An
   entity is named by its kind and its canonical form (lower case, digits only, ...), so all spellings of one
   entity meet here, in whatever document they stand.
3. Each entity gets a surrogate from a keyed hash of its canonical form: letters stay letters of the same
   case and script, digits stay digits, checksums that held hold again, names keep their gender.
4. Collision check: a surrogate that another entity has taken, or that is itself an entity of the corpus, is
   drawn again with the next attempt number until all are distinct.
5. Surrogates go back to the mention lists and between the pieces of the texts. In the pieces, later mentions of a name
   without its title, in full or by the surname, become the same surrogate.

A hot entity or a hot mention list is one row before any join of step 3 and 4; the joins back are equality
joins that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, table, written

DEFAULT_KEY = "surrogates"
MAX_ATTEMPTS = 64

_LABEL = r"[\p{L}\p{N}\-]++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "г-н", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "г-жа", "Госпожа", "Κυρία"],
    "n": ["Dr", "Prof"],
}
_TITLE = r"(?<!\p{L})(?:" + "|".join(t for ts in _TITLES.values() for t in ts) + r")\.? "
_ASSIGNED = r"(?i:password|passwd|token|secret|api[_\-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
# A word of a name: with hyphens or apostrophes in it, or an initial.
_NAME_WORD = r"\p{Lu}(?:[\p{L}\p{M}]++(?:['’\-]\p{L}[\p{L}\p{M}]*+)*+|['’]\p{Lu}[\p{L}\p{M}]++|\.)"
# Lengths of IBANs by country: a match ends where its IBAN ends.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_BODIES = "|".join(
    rf"(?:{names.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in _IBAN_COUNTRIES.items()
)
_WORD_END = r"(?![\p{L}\p{N}])"

# In this order: where two kinds match at one place, the first wins.
PATTERNS = {
    "email": rf"(?<![\p{{L}}\p{{N}}._%+\-])[\p{{L}}\p{{N}}._%+\-]++@{_LABEL}(?:\.{_LABEL})+",
    # The whole value: up to its quote, or to white space without the punctuation of the sentence.
    "secret": rf"{_ASSIGNED}(?:(?<=\")[^\"\r\n]{{8,}}(?=\"|$)|(?<=')[^'\r\n]{{8,}}(?='|$)|[^\s\"'<>]{{7,}}[^\s\"'<>.,;:)\]}}])",
    "key": r"(?<![\p{L}\p{N}])AKIA[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d)(?!\.\d)",
    "phone": r"(?<![\d+])(?:\+?1[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .\-]?\(?\d{2,4}\)?){2,4}(?!\d)"
    r"|(?<![\d.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])(?!\.\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "iban": rf"(?<![\p{{L}}\p{{N}}])(?=[A-Z]{{2}}\d{{2}})(?:(?:{_IBAN_BODIES}){_WORD_END}"
    rf"|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_WORD_END})",
    "card": r"(?<![\d.\-])(?:\d{13,19}|\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\d\-])(?!\.\d)",
    "name": rf"{_TITLE}{_NAME_WORD}(?: {_NAME_WORD}){{0,3}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_MAY_HOLD = rf"[0-9@]|AKIA|{_TITLE}|{_ASSIGNED}"

# Given names by script and gender; surnames are made of syllables.
_GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "Denis", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Noah", "Otto", "Paul"],
    ("latin", "f"): ["Anna", "Berta", "Clara", "Dora", "Emma", "Fiona", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula"],
    ("latin", "n"): ["Alex", "Andrea", "Chris", "Dana", "Eli", "Jona", "Kim", "Luca", "Mika", "Noa", "Robin", "Sam", "Sascha", "Toni", "Vanja", "Yael"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения", "Мария"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя", "Шура"],
    ("greek", "m"): ["Αλέξης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"],
    ("greek", "f"): ["Άννα", "Βασιλική", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία", "Χριστίνα"],
    ("greek", "n"): ["Άρις", "Φώτης", "Φανή", "Χάρις"],
}
_SYLLABLES = {
    "latin": ("bcdfghjklmnprstvwz", "aeiou"),
    "cyrillic": ("бвгджзклмнпрстфх", "аеиоу"),
    "greek": ("βγδζθκλμνπρστφχ", "αειου"),
}


def _hash(key: str, *parts: Column) -> Column:
    """256 keyed bytes as hex, the same for the same parts."""
    blocks = (F.sha2(F.concat_ws("", F.lit(key), F.lit(str(i)), *parts), 512) for i in range(4))
    return F.concat(*blocks)


def _byte(digest: Column, at: Column) -> Column:
    return F.conv(F.substring(digest, F.pmod(at, F.lit(256)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _of(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))) + 1, F.lit(1))


_LOWER = "abcdefghijklmnopqrstuvwxyz"
_SCRIPTS = [  # what a character is replaced from: its class, the alphabet
    (r"[0-9]", "0123456789"),
    (r"[a-z]", _LOWER),
    (r"[A-Z]", _LOWER.upper()),
    (r"\p{IsCyrillic}&&\p{Ll}", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"\p{IsCyrillic}&&\p{Lu}", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"\p{IsGreek}&&\p{Ll}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsGreek}&&\p{Lu}", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{IsLatin}&&\p{Ll}", _LOWER),
    (r"\p{IsLatin}&&\p{Lu}", _LOWER.upper()),
]


def _same_shape(value: Column, digest: Column) -> Column:
    """Each letter or digit replaced by one of its own class, all else as it is."""

    def one(c: Column, i: Column) -> Column:
        number = _byte(digest, i)
        out = F.lit(None).cast("string")
        for cls, alphabet in reversed(_SCRIPTS):
            pattern = f"^{cls}$" if cls.startswith("[") else f"^[{cls}]$"
            out = F.when(c.rlike(pattern), _of(alphabet, number)).otherwise(out)
        return F.coalesce(out, c)

    return F.array_join(F.transform(_chars(value), one), "")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits, counted from the end, replaced by those of ``digits``; further ones stay."""
    spare = F.length(digits)

    def one(c: Column, i: Column) -> Column:
        from_end = F.length(_digits(F.substring(shape, i + 1, F.length(shape))))
        return F.when(c.rlike("^[0-9]$") & (from_end <= spare), F.substring(digits, spare - from_end + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(shape), one), "")


def _random_digits(digest: Column, like: Column) -> Column:
    """As many digits as ``like`` has characters; the first is never 0 or 1."""
    return F.array_join(
        F.transform(_chars(like), lambda c, i: F.when(i == 0, _of("23456789", _byte(digest, i))).otherwise(_of("0123456789", _byte(digest, i)))), ""
    )


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits."""
    back = F.transform(_chars(F.reverse(digits)), lambda c, i: (c.cast("int") * (1 + i % 2)).cast("int"))
    return F.aggregate(back, F.lit(0), lambda total, x: (total + F.when(x > 9, x - 9).otherwise(x)).cast("int")) % 10


def _mod97(iban: Column) -> Column:
    """The remainder of a bare IBAN (country and check digits moved to the end) by 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, F.lit(1), F.lit(4)))

    def step(total: Column, c: Column) -> Column:
        value = F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return ((total * F.when(value > 9, 100).otherwise(10) + value) % 97).cast("int")

    return F.aggregate(_chars(moved), F.lit(0), step)


def kind_of(mention: Column) -> Column:
    """The kind of a match, or null if it fails its check (digits of a card or an IBAN)."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    bare = F.regexp_replace(mention, " ", "")
    wrong = ((out == "iban") & (_mod97(bare) != 1)) | ((out == "card") & (_luhn(_digits(mention)) != 0))
    return F.when(wrong, F.lit(None)).otherwise(out)


def _prefix(kind: Column, mention: Column) -> Column:
    """What stands before the entity itself: a title, or the name of a secret."""
    return F.when(kind == "name", F.regexp_extract(mention, f"^{_TITLE}", 0)).when(
        kind == "secret", F.regexp_extract(mention, f"^{_ASSIGNED}", 0)
    ).otherwise("")


def _gender(prefix: Column) -> Column:
    out = F.lit("n")
    for gender in ("m", "f"):
        out = F.when(prefix.rlike("^(?:" + "|".join(_TITLES[gender]) + r")\.? $"), F.lit(gender)).otherwise(out)
    return out


def _canonical(kind: Column, value: Column, gender: Column) -> Column:
    """One form for all spellings: lower case; digits only, without a North American country code."""
    digits = _digits(value)
    short = F.when((kind == "phone") & (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "ssn", "card"), short)
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "name", F.concat_ws(" ", gender, F.lower(value)))
        .otherwise(value)
    )


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(key: str, canonical: Column, attempt: Column) -> Column:
    """A name in lower case with as many words of the same kinds; the surname depends on the surname alone while attempts are few."""
    gender, words = F.substring(canonical, 1, 1), F.split(F.substring(canonical, F.lit(3), F.length(canonical)), " ")
    before = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    script, last, two = _script(canonical), F.element_at(words, -1), F.size(words) > 1
    own = _hash(key, F.lit("surname"), last, F.when(two, F.floor(attempt / 4)).otherwise(attempt).cast("string"))
    surname = F.lit(None).cast("string")
    for name, (consonants, vowels) in _SYLLABLES.items():
        made = F.concat(*(_of(a, _byte(own, F.lit(i))) for i, a in enumerate((consonants, vowels) * 4)))
        surname = F.when(script == name, made).otherwise(surname)
    pick_at = _hash(key, F.lit("given"), canonical, attempt.cast("string"))

    def given_name(number: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for (name, sex), names in _GIVEN.items():
            own_list = F.array(*(F.lit(n.lower()) for n in names))
            chosen = F.when((script == name) & (gender == sex), F.element_at(own_list, F.pmod(number, F.lit(len(names))) + 1)).otherwise(chosen)
        return chosen

    def stand_in(word: Column, i: Column) -> Column:
        """An initial for an initial, and as many names with hyphens as there were."""
        number = _byte(pick_at, i)
        initial = F.concat(F.substring(given_name(number), 1, 1), F.lit("."))
        parts = F.transform(F.split(word, "-"), lambda _, k: given_name(number + k))
        return F.when(word.rlike(r"^.\.$"), initial).otherwise(F.array_join(parts, "-"))

    return F.concat(gender, F.lit(" "), F.array_join(F.concat(F.transform(before, stand_in), F.array(surname)), " "))


def surrogate_canonical(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The canonical form of the entity's surrogate.

    E-mail addresses and secrets grow by a character with every fourth attempt, so that a shape with few surrogates
    never runs out of them.
    """
    more = F.when(kind.isin("email", "secret"), F.repeat(F.lit("a"), F.floor(attempt / 4).cast("int"))).otherwise("")
    spelt, canonical = canonical, F.concat(more, canonical)
    digest = _hash(key, kind, F.lit("\u0001"), spelt, F.lit("\u0001"), attempt.cast("string"))
    at = F.instr(canonical, "@")
    domain_end = F.length(F.substring_index(canonical, ".", -1)) + 1
    email = F.concat(
        _same_shape(F.substring(canonical, F.lit(1), F.length(canonical) - domain_end), digest), F.lit("."), F.substring_index(canonical, ".", -1)
    )
    octet = [F.pmod(_byte(digest, F.lit(i)), F.lit(223 if i == 0 else 254)) + 1 for i in range(4)]
    body = F.substring(_random_digits(digest, canonical), F.lit(2), F.length(canonical) - 2)
    card = F.concat(F.substring(canonical, 1, 1), body)
    check = F.pmod(F.lit(10) - _luhn(F.concat(card, F.lit("0"))), F.lit(10))
    last = F.when(_luhn(canonical) == 0, check).otherwise(F.pmod(check + 1 + _byte(digest, F.lit(255)) % 9, F.lit(10)))
    account = _same_shape(F.substring(canonical, F.lit(5), F.length(canonical)), digest)
    country = F.substring(canonical, 1, 2)
    iban_check = F.lpad((F.lit(98) - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0")
    hexed = F.array_join(F.transform(_chars(canonical), lambda c, i: _of("0123456789abcdef", _byte(digest, i))), "")
    secret = (
        F.when(canonical.rlike("^[0-9a-f]+$"), hexed)
        .when(canonical.rlike("^[0-9A-F]+$"), F.upper(hexed))
        .otherwise(_same_shape(canonical, digest))
    )
    return (
        F.when((kind == "email") & (at > 0), email)
        .when(kind == "ip", F.concat_ws(".", *octet))
        .when(kind.isin("phone", "ssn"), _random_digits(digest, canonical))
        .when(kind == "card", F.concat(card, last.cast("string")))
        .when(kind == "iban", F.concat(country, iban_check, account))
        .when(kind == "key", F.concat(F.lit("AKIA"), _same_shape(F.substring(canonical, 5, 16), digest)))
        .when(kind == "name", _name(key, canonical, attempt))
        .otherwise(secret)
    )


def _spelled(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of this mention: its case, separators and country code."""
    upper = (F.upper(value) == value) & (F.lower(value) != value)
    email = F.when(upper, F.upper(surrogate)).otherwise(
        F.array_join(F.transform(_chars(surrogate), lambda c, i: F.when(F.substring(value, i + 1, F.lit(1)).rlike(r"^\p{Lu}$"), F.upper(c)).otherwise(c)), "")
    )
    name = F.substring(surrogate, F.lit(3), F.length(surrogate))
    spaced = F.array_join(
        F.transform(
            _chars(value),
            lambda c, i: F.when(c == " ", c).otherwise(
                F.substring(surrogate, F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), " ", "")), F.lit(1))
            ),
        ),
        "",
    )
    return (
        F.when(kind == "email", email)
        .when(kind.isin("phone", "ssn", "card"), _refill(value, surrogate))
        .when(kind == "iban", spaced)
        .when(kind == "name", F.when(upper, F.upper(name)).otherwise(F.array_join(F.transform(F.split(name, "-"), lambda part: F.initcap(part)), "-")))
        .otherwise(surrogate)
    )


def draw_surrogates(entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct entities ``kind, canonical``: one to one, and disjoint from them.

    Of entities that draw the same surrogate the smallest canonical form keeps it; the others draw again.
    """
    taken = entities.select(F.col("kind").alias("k"), F.col("canonical").alias("s"))
    open_, done, attempt = entities, None, 0
    while True:
        drawn = written(open_.select("kind", "canonical", surrogate_canonical(F.col("kind"), F.col("canonical"), F.lit(attempt), key).alias("surrogate")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = first.join(taken, (first.kind == taken.k) & (first.surrogate == taken.s), "left_anti")
        if done is not None:
            used = done.select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
            good = good.join(used, (good.kind == used.k) & (good.surrogate == used.s), "left_anti")
        good = written(good.select("kind", "canonical", "surrogate"), "surrogates")
        # One table of all so far: a later round reads it, not each round's own.
        done = good if done is None else written(done.unionByName(good), "surrogates-so-far")
        open_ = drawn.select("kind", "canonical").join(good.select("kind", "canonical"), ["kind", "canonical"], "left_anti")
        if not open_.limit(1).count():
            return done
        attempt += 1
        if attempt == MAX_ATTEMPTS:
            raise ValueError("a kind has more entities than surrogates")


def _aliases(mention: Column, new: Column) -> Column:
    """What a name with a title is called without it, and what that becomes: in full, and by the surname."""
    title = F.lit(f"^{_TITLE}")

    def bare(name: Column) -> Column:
        return F.regexp_replace(name, title, F.lit(""))

    def last(name: Column) -> Column:
        return F.element_at(F.split(bare(name), " "), -1)

    pairs = F.array(F.struct(bare(mention).alias("old"), bare(new).alias("new")), F.struct(last(mention).alias("old"), last(new).alias("new")))
    return F.filter(pairs, lambda p: F.length(p["old"]) > 2)


def _without_titles(piece: Column, aliases: Column) -> Column:
    """A piece of text with the aliases in it replaced, whole words only, longer ones first."""

    def one(text: Column, alias: Column) -> Column:
        found = text.contains(alias["old"])
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), alias["old"], F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.when(found, F.regexp_replace(text, pattern, alias["new"])).otherwise(text)

    return F.aggregate(aliases, piece, one)


def replace_entities(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with its text replaced and two more columns at the end, ``n_entities, kinds``; row order isn't kept.

    * A null or empty text stays as it is and has no entities. Texts are searched whole.
    * The same entity gets the same surrogate in all texts; different ones get different surrogates, none of
      which is an entity of the input. Repeated rows give the same texts. An empty table gives no rows.
    * A name without its title is replaced where the same text also has it with one; it isn't counted again.
    * Other columns come back unchanged, whatever their names, also ``n_entities`` or ``kinds``.
    """
    names = docs.columns
    plain = docs.toDF(*(f"_{i}" for i in range(len(names))))
    text = f"_{names.index(text_col)}"
    own = [f"_{i}" for i in range(len(names))]
    matches = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    found = written(plain.withColumn("mentions", F.when(F.col(text).rlike(_MAY_HOLD), matches)), "found-mentions")
    without = found.where("mentions is null or size(mentions) = 0").select(
        *own, F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds")
    )
    held = found.where("size(mentions) > 0").withColumn("list", F.sha2(F.array_join("mentions", "\u0001"), 256))

    lists = written(held.groupBy("list").agg(F.first("mentions").alias("mentions")), "mention-lists")
    at = lists.select("list", F.posexplode("mentions").alias("place", "mention"))
    spelt = at.groupBy("mention").agg(F.count(F.lit(1)).alias("n")).select("mention", kind_of(F.col("mention")).alias("kind")).where("kind is not null")
    spelt = spelt.withColumn("prefix", _prefix(F.col("kind"), F.col("mention")))
    spelt = spelt.withColumn("value", F.substring(F.col("mention"), F.length("prefix") + 1, F.length("mention")))
    spelt = written(spelt.withColumn("canonical", _canonical(F.col("kind"), F.col("value"), _gender(F.col("prefix")))), "mentions")
    surrogates = draw_surrogates(spelt.select("kind", "canonical").distinct(), key)
    of_mention = written(
        spelt.join(surrogates, ["kind", "canonical"]).select(
            "mention", "kind", F.concat("prefix", _spelled(F.col("kind"), F.col("value"), F.col("surrogate"))).alias("new")
        ),
        "spelled",
    )
    entry = F.struct("place", F.coalesce("new", at.mention).alias("new"), "kind", F.when(F.col("kind") == "name", _aliases(F.col("mention"), F.col("new"))).alias("aliases"))
    news = at.join(of_mention, "mention", "left").groupBy("list").agg(F.sort_array(F.collect_list(entry)).alias("news"))
    called = F.array_distinct(F.flatten(F.filter("news.aliases", lambda a: a.isNotNull())))
    longest_first = F.transform(F.sort_array(F.transform(called, lambda a: F.struct(-F.length(a["old"]), a["old"].alias("old"), a["new"].alias("new")))), lambda a: F.struct(a["old"].alias("old"), a["new"].alias("new")))
    replaced = written(news.withColumn("aliases", longest_first), "replaced")
    pieces = F.split(F.col(text), ANY, -1)
    pieces = F.when(F.size("aliases") > 0, F.transform(pieces, lambda piece: _without_titles(piece, F.col("aliases")))).otherwise(pieces)
    mixed = F.zip_with(pieces, F.col("news.new"), lambda piece, new: F.concat(piece, F.coalesce(new, F.lit(""))))
    kinds = F.filter("news.kind", lambda k: k.isNotNull())
    with_ = held.join(replaced, "list").select(
        *[F.array_join(mixed, "").alias(c) if c == text else F.col(c) for c in own], F.size(kinds).alias("n_entities"), kinds.alias("kinds")
    )
    return without.unionByName(with_).toDF(*names, "n_entities", "kinds")


def op9_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return replace_entities(docs)
