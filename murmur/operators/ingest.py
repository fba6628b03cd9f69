"""From raw messages to the latest document per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Times in text, with a zone and without, keep all that Spark holds of them.
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def decode(messages: DataFrame) -> DataFrame:
    """Binary key and value as UTF-8 text; a missing or empty key is null.

    ``timestamp`` is when the broker took a message, null where a source has none.
    """
    arrival = F.col("timestamp") if "timestamp" in messages.columns else F.lit(None).cast("timestamp")
    return messages.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.nullif(F.col("key").cast("string"), F.lit("")).alias("key"),
        F.col("value").cast("string").alias("value"),
        arrival.alias("timestamp"),
    )


def parse_messages(
    messages: DataFrame, schema: str
) -> tuple[DataFrame, DataFrame]:
    """Split messages into those whose value is JSON, parsed, and the raw rest; a field of another type than
    ``schema`` wants is null, and its message stays."""
    good, bad = split_messages(messages)
    return good.withColumn("value", F.from_json("value", schema)), bad


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages whose value is JSON, and the rest.

    As ordinary JSON readers have it, a name given twice is no fault (the last one
    holds), nor are NaN and infinities. A value must be one JSON value to its end: it must be one
    element between brackets and one field between braces, as what ends the one early breaks the other.
    """
    element = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")
    field = F.from_json(
        F.concat(F.lit('{"v":'), "value", F.lit("}")), "v string, _broken string", {"columnNameOfCorruptRecord": "_broken"}
    )
    one = F.coalesce(F.size(element) == 1, F.lit(False))
    ok = one & F.col("value").isNotNull() & field["_broken"].isNull()
    return messages.filter(ok), messages.filter(~ok)


# Decimal digits that a value of an order's column takes, by type, and the number that makes the least of them 0. Places in
# a log have 15 digits and numbers of its parts 5; times reach from the year 1 to 9999.
_DIGITS = {"timestamp": (18, 62_135_596_800_000_000), "int": (5, 0), "bigint": (15, 0)}


def _is_number(rows: DataFrame, order: Sequence[str]) -> bool:
    kinds = dict(rows.dtypes)
    return all(kinds[c] in _DIGITS for c in order) and sum(_DIGITS[kinds[c]][0] for c in order) <= 38


def order_number(rows: DataFrame, order: Sequence[str]) -> Column:
    """The columns of an order as one number that sorts as they do, nulls first.

    A number, unlike a row of columns, is held in place by a hash aggregate. What doesn't fit ends the job.
    """
    total = F.lit(0).cast("decimal(38,0)")
    kinds = dict(rows.dtypes)
    if not _is_number(rows, order):
        raise ValueError(f"{[kinds[c] for c in order]} is no order of a log")
    for c in order:
        digits, least = _DIGITS[kinds[c]]
        whole = F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c).cast("bigint")
        place = whole + least + 1  # 0 is for nulls
        fits = (place >= 1) & (place < 10**digits)
        place = F.when(F.col(c).isNull(), F.lit(0)).when(fits, place).otherwise(F.raise_error(F.concat(F.lit(f"{c} is out of its order's range: "), F.col(c).cast("string"))))
        total = (total * F.lit(10**digits).cast("decimal(19,0)") + place.cast("decimal(19,0)")).cast("decimal(38,0)")
    return total


def _extreme_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick: Callable[[str], Column]) -> DataFrame:
    """The rows whose order is picked within their key: an aggregate of keys and numbers, then a semi join.

    The aggregate reads nothing but keys and order. The join is by key and order, so the rows of a hot key spread.
    """
    marked = rows.withColumn("_at", order_number(rows, order))
    best = marked.groupBy(*(F.col(k).alias(f"_of_{k}") for k in keys)).agg(pick("_at").alias("_best"))
    same = F.col("_at") == F.col("_best")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    found = marked.join(best, same, "left_semi")
    # a message that was delivered twice has two rows; no key is hot any more
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    return found.withColumn("_copy", copy).filter("_copy = 1").drop("_at", "_copy")


def latest_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last one by ``order``; null keys share one row.

    ``order`` should tell the rows of a key apart; of rows that share the last place any one stays. Orders of times, parts
    and places of a log are compared as one number; others, as rows, take an aggregate that sorts.
    """
    if _is_number(rows, order):
        return _extreme_by_key(rows, keys, order, F.max)
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns)
    )


def first_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first one by ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns)
    )


ENVELOPE = ("topic", "partition", "offset", "timestamp")


def _winners(messages: DataFrame, names: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Messages with their place, and for each key the places where a field was last given, with these fields.

    One hash aggregate over keys and numbers. A field that a message doesn't name is left as it was; one that
    it sets to null is given. The envelope, under the name "", comes from the last message.
    """
    given = F.map_keys(F.from_json("value", "map<string,string>"))
    marked = messages.withColumn("_at", order_number(messages, order))
    named = marked.select(*keys, "_at", given.alias("_given"))
    held = [F.max(F.when(F.array_contains("_given", n), F.col("_at"))) for n in names]
    last = named.groupBy(*(F.col(k).alias(f"_of_{k}") for k in keys)).agg(
        F.array(F.max("_at"), *held).alias("_places")
    )
    owns = F.array(*(F.lit(n) for n in ("", *names)))
    pairs = F.arrays_zip(F.col("_places").alias("at"), owns.alias("name"))
    fields = lambda at: F.transform(F.filter(pairs, lambda p: p["at"] == at), lambda p: p["name"])
    places = F.transform(F.array_distinct(F.array_compact("_places")), lambda at: F.struct(at.alias("at"), fields(at).alias("fields")))
    won = last.select(*(f"_of_{k}" for k in keys), F.explode(places).alias("_won"))
    return marked, won.select(*(f"_of_{k}" for k in keys), F.col("_won.at").alias("_place"), F.col("_won.fields").alias("_fields"))


def _at_winners(marked: DataFrame, won: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    same = F.col("_at") == F.col("_place")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return marked.join(won, same, how)


def field_winners(messages: DataFrame, schema: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The messages that any field of their key comes from: what a log must keep of a batch, at most one per field.

    Merging the winners of several batches gives what merging all their messages gives.
    """
    marked, won = _winners(messages, _names(messages, schema), keys, order)
    return _at_winners(marked, won, keys, "left_semi").drop("_at")


def merge_fields_by_key(messages: DataFrame, schema: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One document per key: the envelope of its last message, and each field of ``value`` as it was last given.

    ``messages`` are good ones with their value as text; ``order`` tells the messages of a key apart. A field that no message
    gives is null. Values that are no objects give no field.
    """
    names = _names(messages, schema)
    marked, won = _winners(messages, names, keys, order)
    rows = _at_winners(marked, won, keys, "inner").withColumn("_value", F.from_json("value", schema))

    def held(name: str, what: Column) -> Column:
        """From the one message of the key that has it; a null is held in a struct, so it isn't passed over."""
        return F.get(F.collect_list(F.when(F.array_contains("_fields", name), F.struct(what.alias("v")))), F.lit(0))["v"]

    envelope = [c for c in ENVELOPE if c in messages.columns and c not in keys]
    merged = rows.groupBy(*keys).agg(
        *(held("", F.col(c)).alias(c) for c in envelope), *(held(n, F.col("_value").getField(n)).alias(f"_f_{i}") for i, n in enumerate(names))
    )
    value = F.struct(*(F.col(f"_f_{i}").alias(n) for i, n in enumerate(names)))
    return merged.select(*(c for c in messages.columns if c in (*keys, *envelope)), value.alias("value"))


def _names(messages: DataFrame, schema: str) -> list[str]:
    """The fields of a value."""
    return messages.select(F.from_json("value", schema).alias("v")).schema["v"].dataType.fieldNames()


def to_messages(rows: DataFrame, key: str) -> DataFrame:
    """Rows as (key, value) messages; null fields stay in the JSON."""
    fields = F.struct(*rows.columns)
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(fields, {"ignoreNullFields": "false", **MICROS}).alias("value"),
    )
