"""Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def empty_to_null(c: Column) -> Column:
    """Text loads treat an empty field as missing."""
    return F.nullif(c, F.lit(""))


def first_of(c: Column) -> Column:
    """First array element, NULL if there is none."""
    return F.get(c, F.lit(0))


def flat(arrays: Column, field: str) -> Column:
    """Concatenate ``field`` of every struct in ``arrays``, in document order."""
    return F.flatten(
        F.filter(F.transform(arrays, lambda s: s[field]), lambda a: a.isNotNull())
    )


def strict_cast(c: Column, to: str | T.DataType, what: str) -> Column:
    """Cast that fails the job on bad text, whatever the session's ANSI setting is."""
    cast = c.try_cast(to)
    message = F.concat(F.lit(f"bad value for {what}: "), c)
    return F.when(c.isNotNull() & cast.isNull(), F.raise_error(message).cast(to)).otherwise(cast)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` by name and cast text to its types, '' becoming NULL."""
    present = {f.name: f.dataType for f in df.schema}
    out = []
    for f in schema:
        c = F.col(f.name)
        if isinstance(present[f.name], T.StringType):
            c = empty_to_null(c)
            if not isinstance(f.dataType, T.StringType):
                c = strict_cast(c, f.dataType, f.name)
        elif present[f.name] != f.dataType:
            c = c.cast(f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def valid_json(c: Column) -> Column:
    """TRUE for NULL or well-formed JSON text."""
    return c.isNull() | F.try_parse_json(c).isNotNull()
