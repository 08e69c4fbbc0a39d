"""The lexer against an XML parser, for documents cut at any byte."""

import random
import re
import xml.etree.ElementTree as ET

import pytest
from conftest import document, entry, rows
from pyspark.sql import functions as F

from kbetl.operators import shred as sh
from kbetl.operators.quality import load_violations
from kbetl.plans.load import stage_entries
from kbetl.sources import entries, markup
from kbetl.sources.entries import cut_fragments, incomplete_documents, scan_fragments, split_contexts, suspect_files

TAGS = markup.Tags("entry")
HIDDEN = [
    "<!-- a > b -->", "<!--</entry>-->", "<!-- <entry> -->", "<!--\n<entry><accession>X</accession></entry>\n-->",
    "<!--<entry/><entry></entry><entry>-->", "<![CDATA[</entry>]]>", "<![CDATA[<entry><!-- ]]>", "<![CDATA[]]]]><![CDATA[>]]>",
    "<?entry </entry> ?>", "<!-- - -> ]]> ?> <![CDATA[ -->", "<!---->",
]


def random_document(r):
    """A document of entries with hidden markup anywhere, and the accessions an XML parser finds."""
    prefix = r.choice(["", "", "u:"])
    close = lambda: f"</{prefix}entry{r.choice(['', '', ' ', chr(10)])}>"
    noise = lambda k: "".join(r.choices([*HIDDEN, " ", "\n", "x > y", "]]&gt;"], k=r.randint(0, k)))
    comments = lambda k: "".join(r.choices([h for h in HIDDEN if not h.startswith("<![")], k=r.randint(0, k)))
    parts = []
    for i in range(r.randint(0, 9)):
        attributes = r.choice(["", " a='x>y'", ' note="/>" b = "c"', "\n"])
        parts.append(f"{comments(2)}<{prefix}entry{attributes}><{prefix}accession>{i}</{prefix}accession>{noise(3)}<{prefix}entrys>{noise(2)}</{prefix}entrys>{close()}")
        if r.random() < 0.2:
            parts.append(f"<{prefix}entry a='>' />")
    subset = r.choice(["", "", "<!DOCTYPE kb [<!ENTITY e '<entry>'> <!-- ] > -->\n] >"])
    declared = r.choice(['xmlns:u="http://u"', "xmlns:u = 'http://u'"])
    return f"{comments(1)}{subset}<{prefix}kb {declared} xmlns:x='y>z'>" + "\n".join(parts) + f"</{prefix}kb>" + comments(2) + r.choice(["", "\n"])


def split_at(text: bytes, places):
    """Records of every split, as a line reader deals them: a record belongs to the split that holds the byte before it."""
    records, at = [], 0
    for part in text.split(b"<"):
        records.append((at, part))
        at += len(part) + 1
    bounds = [0, *places]
    out = [[] for _ in bounds]
    for start, part in records:
        if start < len(text):
            out[max(i for i, b in enumerate(bounds) if b < start or not i)].append(part)
    return [(b, rs) for b, rs in zip(bounds, out) if rs]


def lexed(text: bytes, places, batch=5):
    splits = split_at(text, places)
    context, contexts = None, {}
    for block, records in splits:
        survey, root = markup.Survey(TAGS, block), markup.Root()
        for r in records[0 if block else 1 :]:
            survey.feed(r)
        if context is None:
            for r in records:
                root.feed(r)
            context = markup.Context(declared=markup.declarations(root.record or b""))
        contexts[block] = context
        context = context.after(block, survey.ends, survey.open_block, survey.prefix)
    pieces, summaries = [], []
    for block, records in splits:
        cutter = markup.Cutter(TAGS, block, contexts[block])
        for at in range(0, len(records), batch):
            part = records[at : at + batch]
            pieces += cutter.feed(part, range(len(part)))
        pieces += cutter.finish()
        summaries.append(cutter.summary())
    whole, parts = [], {}
    for p in pieces:
        if p.whole:
            whole.append((p.start_block, b"<" + p.text, p.starts))
        else:
            parts.setdefault(p.start_block, []).append(p)
    for block, ps in parts.items():
        if any(p.ends for p in ps):
            whole.append((block, b"<" + b"<".join(p.text for p in ps), sum(p.starts for p in ps)))
    closed = [c for _, c, _ in summaries if c is not None]
    return whole, bool(summaries) and closed[-1:] == [summaries[0][0]] and summaries[-1][2]


@pytest.mark.parametrize("seed", range(60))
def test_entries_are_those_of_a_parser_wherever_it_is_cut(seed):
    r = random.Random(seed)
    text = random_document(r)
    root = ET.fromstring(text)
    want = [e.findtext("{*}accession") for e in root.iter() if e.tag.rpartition("}")[2] == "entry" and len(e)]
    data = text.encode()
    rest = range(data.index(b"xmlns:x"), len(data))  # the root's start tag is in the first split
    for k in (0, 1, 3, 20):
        places = sorted(r.sample(rest, min(k, len(rest))))
        found, complete = lexed(data, places)
        assert all(starts == 1 for _, _, starts in found) and complete
        read = [ET.fromstring(b"<r xmlns:u='u' xmlns:x='x'>" + xml + b"</r>")[0].findtext("accession") for _, xml, _ in found]
        assert sorted(read, key=int) == want
    cut = data[: data.rindex(b"<", 0, data.rindex(b"kb>"))] + data[data.rindex(b"kb>") + 3 :]
    assert not lexed(cut, [len(cut) // 2])[1]


def commented(n):
    parts = []
    for i in range(n):
        parts.append(entry(f"A{i}", go=[f"GO:{i}"], extra=f"<comment type='function'><text><![CDATA[</entry> {i}]]></text></comment>" if i % 3 == 0 else ""))
        if i % 4 == 0:
            parts.append("<!--" + "\n".join(entry(f"X{i}_{k}") for k in range(3)) + "-->")
    return document(*parts)


@pytest.mark.parametrize("size", [1 << 30, 4096])
def test_one_split_or_many(spark, write, size):
    path = write(commented(120))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        fragments = scan_fragments(spark, path)
        p = sh.parse_entry(fragments, mode="PERMISSIVE")
        assert load_violations(p).count() == 0
        assert sorted(r[0] for r in rows(sh.shred_proteins(p), "primary_accession")) == sorted(f"A{i}" for i in range(120))
        text = F.get_json_object("comments_data", "$[0].children[0].text")
        assert sh.shred_proteins(p).where(text.startswith("</entry> ")).count() == 40
        if size == 4096:
            assert split_contexts(spark, [path]).count() > 10
        staged = stage_entries(spark, {"d": path}, path + f"-staged-{size}", "full")
        assert staged.where("primary_accession is not null").count() == 120
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_files_that_need_it_are_lexed(spark, write):
    plain = write(document(entry("A"), "<!-- no tag -->", "<entry/>", entry("B")), "a.xml")
    write(document("<!--" + entry("X") + entry("Y") + "-->", entry("C")), "b.xml")
    folder = plain.rsplit("/", 1)[0]
    odd = suspect_files(cut_fragments(spark, folder))
    assert [r.file.rsplit("/", 1)[1] for r in odd.collect()] == ["b.xml"]
    fragments = scan_fragments(spark, folder)
    assert rows(sh.shred_proteins(sh.parse_entry(fragments)), "primary_accession") == [("A",), ("B",), ("C",)]
    assert incomplete_documents(fragments).count() == 0
    staged = stage_entries(spark, {"one": plain, "two": folder + "/b.xml"}, folder + "-staged")
    assert rows(staged.where("primary_accession is not null"), "dataset", "primary_accession") == [("one", "A"), ("one", "B"), ("two", "C")]
    with pytest.raises(ValueError, match="CDATA"):
        scan_fragments(spark, folder + "/b.xml", row_tag="CDATA").count()


def plain_patterns(value, row_tag="entry"):
    """The suspect flag of a fragment without hidden parts, by its definition."""
    at = re.search(rf"<{row_tag}[\s>]", value)
    prefixed = at and re.search(r"</?[A-Za-z_][\w.\-]*:|\s[A-Za-z_][\w.\-]*:[\w.\-]+\s*=\s*[\"']", value[at.start() :], re.ASCII)
    other = re.search(rf"</?[^\s<>/:=\"'!?&;]+:{row_tag}[\s/>]|</{row_tag}\s+>", value, re.ASCII)
    return bool(re.search(r"<!--|<!\[CDATA\[|<\?|<!DOCTYPE[^>]*\[", value) or len(re.findall(rf"<{row_tag}[\s>]", value)) > 1 or other or prefixed)


def test_suspects_are_those_of_the_plain_patterns(spark, write):
    r = random.Random(5)
    bits = ["<entry>", "<entry a='1'>", "</entry >", "<x:entry ", "x:entry", ":entry>", "</x:entry>", "<y:b>", "</y:b", " k:v = \"1\"", " k:v='", "\tk:", ":v=", "a:b", " 1:2='", "http://e.org", "<!--", "<![CDATA[", "<?", "<!", "<!DOCTYPE a [", " ", "é", "<b>", "/"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 6))) for _ in range(400)]
    # Pieces that can hide something, or be an empty entry, are looked at after hiding it: not by this definition.
    texts = [t for t in texts if not re.search(r"(?s)<!--.*-->|<!\[CDATA\[.*\]\]>|<\?.*\?>|<!DOCTYPE.*>|<entry(\s[^<>]*)?/>", t)]
    path = write("</entry>".join(texts) + "</entry>", "s.xml")
    found = [x.suspect for x in cut_fragments(spark, path).orderBy("ord").collect()]
    assert found == [plain_patterns(t) for t in texts] and 50 < sum(found) < len(found) - 50


def test_patterns_stand_behind_literals(spark, write):
    suspect = cut_fragments(spark, write(document(entry("P1"))))._jdf.queryExecution().analyzed().toString().lower()
    assert all(f"contains(bare#{n}, {literal})" in re.sub(r"bare#\d+", "bare#0", suspect) for n in (0,) for literal in (":", ":entry", "</entry", "<!", "<?"))


def test_prefixes_of_any_length_are_suspects(spark, write):
    texts = [f"<entry><{'/' * (n % 2)}{'n' * n}{c}b> a:b 1:2" for n in (1, 31, 32, 33, 34, 90) for c in (":", ";:", ".:")]
    path = write("</entry>".join(texts) + "</entry>", "s.xml")
    cut = cut_fragments(spark, path)
    assert [x.suspect for x in cut.orderBy("ord").collect()] == [plain_patterns(t) for t in texts] == [True, False, True] * 6
    # The exact patterns stand behind one that looks at colons only.
    assert "RLIKE(bare#0, :(" in re.sub(r"bare#\d+", "bare#0", cut._jdf.queryExecution().analyzed().toString())


def test_plain_files_are_listed_once(spark, write, monkeypatch):
    plain = write(document(entry("P1")), "p.xml")
    packed = write(document(entry("P2"), entry("P3")), "q.xml.gz")

    def listing(*_):
        raise AssertionError("listed once more")

    monkeypatch.setattr(entries, "input_files", listing)
    assert cut_fragments(spark, plain).count() == 2
    with pytest.raises(AssertionError, match="once more"):
        cut_fragments(spark, [plain, packed])
    monkeypatch.undo()
    assert cut_fragments(spark, [plain, packed]).count() == 5


def test_names_of_files_are_read_by_one_job(spark, write):
    paths = [write(document(entry(f"P{i}")), f"f{i}.xml") for i in range(6)]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    spark.sparkContext.setJobGroup("names", "names")
    try:
        named = entries.readable_paths(spark, paths)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("names")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(named) == 6 and len(jobs) == 1
