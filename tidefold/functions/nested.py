"""Multi-message texts and nested documents."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what stands between two messages of one file.
MESSAGE_DELIMITER = "*&*&*&*&*&*&*&*&*&*&*&*&*&*&*&*"


def split_messages(text: Column, delimiter: str = MESSAGE_DELIMITER, keep_whole: bool = False) -> Column:
    """The messages of one file as an array, each without one leading line feed.

    Empty pieces are left out. With ``keep_whole`` a text that has an empty piece is not
    split at all but returned as one message, leading line feed removed.
    """
    quoted = "".join("\\" + c for c in delimiter)
    pieces = F.split(text, quoted)
    trimmed = F.transform(F.filter(pieces, lambda m: m != ""), lambda m: F.regexp_replace(m, r"^\n", ""))
    if not keep_whole:
        return F.filter(trimmed, lambda m: m != "")
    whole = F.array(F.regexp_replace(text, r"^\n", ""))
    return F.when(F.exists(pieces, lambda m: m == ""), whole).otherwise(trimmed)


def _last_present(array: Column, pick: Callable[[Column], Column]) -> Column:
    values = F.filter(F.transform(array, lambda e: pick(e)), lambda v: v.isNotNull())
    return F.try_element_at(values, F.lit(-1))


def _leaves(kind: T.DataType) -> Iterator[tuple[tuple[str, ...], Callable[[Column], Column]]]:
    """Path and accessor of every leaf. Of list elements the last that has the leaf counts."""
    if isinstance(kind, T.StructType):
        for f in kind:
            for path, pick in _leaves(f.dataType):
                yield (f.name, *path), partial(lambda n, p, c: p(c.getField(n)), f.name, pick)
    elif isinstance(kind, T.ArrayType):
        for path, pick in _leaves(kind.elementType):
            yield path, partial(lambda p, c: _last_present(c, p), pick)
    else:
        yield (), lambda c: c


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Replace a nested column by one column per leaf, named by its dotted path."""
    kind = df.schema[column].dataType
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*rest, *(pick(F.col(column)).alias(".".join(path)) for path, pick in _leaves(kind)))


def xml_schema(df: DataFrame, column: str) -> T.StructType:
    """A schema that fits all documents of an XML text column.

    The XML reader infers it from all of them in its tasks, so elements that only one of them has are in it. A document
    that cannot be parsed shows nothing.
    """
    spark = df.sparkSession
    body = F.regexp_replace(column, r"^\s*<\?xml[^>]*\?>", "")
    texts = df.filter(F.col(column).isNotNull()).select(body.alias(column))
    # The reader takes a dataset of texts in the JVM; its Python side takes paths only.
    texts = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark._jsparkSession.read().option("samplingRatio", "1.0").option("mode", "DROPMALFORMED")
    # Every document has one root element, whose name XML parsing drops.
    return T.StructType.fromJson(json.loads(reader.xml(texts).schema().json()))


def flatten_xml(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    """Parse an XML text column by ``schema``, or by what all its documents show, and flatten it."""
    schema = schema or xml_schema(df, column)
    parsed = df.withColumn(column, F.from_xml(F.col(column), schema.simpleString()))
    return flatten_struct(parsed, column)


def column_ending(df: DataFrame, tag: str) -> str:
    """The first column whose name ends with ``tag``."""
    return next(c for c in df.columns if c.endswith(tag))


def path_containing(df: DataFrame, tag: str) -> str:
    """The first column name that contains ``tag``, cut off behind it."""
    return next(re.match(f".*?{re.escape(tag)}", c).group() for c in df.columns if tag in c)
