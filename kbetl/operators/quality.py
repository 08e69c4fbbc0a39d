"""Quality gates: each check is a DataFrame of violations, ``assert_*`` raises if it has rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import valid_json
from ..schemas import TABLES, Table
from ..sources.entries import incomplete_documents


class QualityError(ValueError):
    """A gate found violations; the message shows some of them."""


def require_none(violations: DataFrame, what: str, shown: int = 10) -> None:
    """Raise if there are violations. Only ``shown`` of them reach the driver."""
    rows = violations.limit(shown + 1).collect()
    if rows:
        listed = "; ".join(str(tuple(r)) for r in rows[:shown])
        more = " ..." if len(rows) > shown else ""
        raise QualityError(f"{what}: {listed}{more}")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (pre-aggregated before the shuffle)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key."""
    return df.where(_any([F.col(c).isNull() for c in key])).select(*key)


def length_violations(df: DataFrame, key: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """Values longer than allowed: key columns, column_name, value_length."""
    checks = [
        F.when(
            F.length(c) > n,
            F.struct(F.lit(c).alias("column_name"), F.length(c).alias("value_length")),
        )
        for c, n in limits.items()
    ]
    too_long = _any([F.length(c) > n for c, n in limits.items()])
    return df.where(too_long).select(*key, F.inline(F.array_compact(F.array(*checks))))


def invalid_json(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """JSON text that does not parse: key columns, column_name."""
    bad = {c: ~valid_json(F.col(c)) for c in columns}
    named = [F.when(condition, F.lit(c)) for c, condition in bad.items()]
    return df.where(_any(list(bad.values()))).select(
        *key, F.explode(F.array_compact(F.array(*named))).alias("column_name")
    )


def fk_orphans(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Referencing keys without a parent and how many rows use them; NULL references pass.

    The child side is counted per key first, so a key that owns most rows enters the join once.
    """
    used = (
        child.where(~_any([F.col(c).isNull() for c in columns]))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    target = parent.select(*(F.col(p).alias(c) for c, p in zip(columns, parent_columns)))
    return used.join(target, list(columns), "left_anti")


def assert_unique(df: DataFrame, key: Sequence[str], what: str = "duplicate key") -> None:
    require_none(duplicate_keys(df, key), what)


def assert_primary_key(df: DataFrame, key: Sequence[str], what: str = "table") -> None:
    require_none(null_keys(df, key), f"{what}: NULL in key {tuple(key)}")
    require_none(duplicate_keys(df, key), f"{what}: duplicate key {tuple(key)}")


def assert_lengths(df: DataFrame, key: Sequence[str], limits: Mapping[str, int], what: str = "table") -> None:
    require_none(length_violations(df, key, limits), f"{what}: value too long")


def assert_foreign_key(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    parent_columns: Sequence[str],
    what: str = "table",
) -> None:
    require_none(fk_orphans(child, parent, columns, parent_columns), f"{what}: no parent for {tuple(columns)}")


def malformed(parsed: DataFrame) -> DataFrame:
    """Positions of malformed entries; ``parsed`` comes from a permissive parse."""
    return parsed.where("malformed").select("dataset", "file", "block", "ord")


def assert_well_formed(parsed: DataFrame) -> None:
    require_none(malformed(parsed), "malformed entry at")


def check_tables(tables: Mapping[str, DataFrame], specs: Mapping[str, Table] = TABLES) -> None:
    """Keys, lengths and references of loose tables (for staged entries see ``check_entries``)."""
    for name, df in tables.items():
        spec = specs[name]
        assert_primary_key(df, spec.key, name)
        if spec.max_length:
            assert_lengths(df, spec.key, spec.max_length, name)
        if spec.json_columns:
            require_none(invalid_json(df, spec.key, spec.json_columns), f"{name}: not JSON")
        for columns, parent, parent_columns in spec.references:
            if parent in tables:
                assert_foreign_key(df, tables[parent], columns, parent_columns, name)


# Repeated parts of a parsed entry: array column, key field (None: the element itself), table.
_REPEATED = (
    ("secondary", None, "accessions", "secondary_accession"),
    ("genes", "gene_name", "genes", "gene_name"),
    ("keywords", "keyword_id", "keywords", "keyword_id"),
    ("go_ids", None, "protein_to_go", "go_term_id"),
)


ON_DUPLICATE = ("fail", "keep_first")


def check_on_duplicate(value: str) -> None:
    if value not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {value!r}")


def entry_violations(parsed: DataFrame, on_duplicate: str = "fail") -> DataFrame:
    """Everything about one entry that breaks a key or a length: accession, table_name, problem.

    Child keys start with the accession, so once accessions are unique a child key can only repeat
    inside one entry. That makes this a row-local filter: no shuffle for the child tables.
    """
    check_on_duplicate(on_duplicate)
    problems: list[Column] = []

    def add(condition: Column, table: str, text: str) -> None:
        problems.append(
            F.when(condition, F.struct(F.lit(table).alias("table_name"), F.lit(text).alias("problem")))
        )

    for table in ("proteins", "taxonomy"):
        for column, limit in TABLES[table].max_length.items():
            add(F.length(column) > limit, table, f"{column} longer than {limit}")
    def values_of(array: str, field: str | None) -> Column:
        return F.transform(array, lambda s: s[field]) if field else F.col(array)

    def any_longer(values: Column, limit: int) -> Column:
        return F.coalesce(F.exists(values, lambda v: F.length(v) > limit), F.lit(False))

    for array, field, table, column in _REPEATED:
        keys = values_of(array, field)
        add(F.exists(keys, lambda v: v.isNull()), table, f"{column} is NULL")
        if on_duplicate == "fail":
            add(F.size(F.array_distinct(keys)) < F.size(keys), table, f"{column} repeated in entry")
        for name, limit in TABLES[table].max_length.items():
            if name != "protein_accession":
                texts = values_of(array, name if field else None)
                add(any_longer(texts, limit), table, f"{name} longer than {limit}")
    return parsed.where(F.col("primary_accession").isNotNull()).select(
        "primary_accession", F.inline(F.array_compact(F.array(*problems)))
    )


def load_violations(parsed: DataFrame, on_duplicate: str = "fail") -> DataFrame:
    """All gates of a load on staged (written) parsed entries, as (problem, at).

    One job over a few narrow columns, one shuffle of accessions and one of file names.
    References need no check: every child row and every organism row comes from an entry that has
    the parent row.
    """
    entries = parsed.where(F.col("primary_accession").isNotNull())
    gates = {
        "malformed entry": malformed(parsed),
        "document is cut off": incomplete_documents(parsed),
        "duplicate primary accession": duplicate_keys(entries, ["primary_accession"]),
        "entry breaks a key or length rule": entry_violations(parsed, on_duplicate),
    }
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(gate).alias("problem"), F.to_json(F.struct(*df.columns)).alias("at")) for gate, df in gates.items()],
    )


def check_entries(parsed: DataFrame, on_duplicate: str = "fail") -> None:
    require_none(load_violations(parsed, on_duplicate), "release rejected")
