"""Deeply nested semi-structured records into flat tables that keep the link to their parent.

Everything is a projection: payloads become variants, nested ``transform`` calls attach the ancestors' keys and
positions, ``flatten`` joins the arrays and one ``inline`` per target table emits the rows. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.stages import settled
from tallyloom.functions.text import address, blank_to_null, whole


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def parse(text: Column) -> Column:
    """A variant of a well-formed JSON text, else null. Text after the value counts as not well-formed."""
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return let(one, lambda a: F.when(F.size(a) == 1, a[0]))


def unfold(v: Column) -> Column:
    """JSON text inside a variant is parsed, one layer; text that is no JSON becomes null. ``v`` must be cheap."""
    return F.when(F.schema_of_variant(v) == "STRING", parse(F.try_variant_get(v, "$", "string"))).otherwise(v)


def item(up: Column, pos: Column, single: Column, v: Column) -> Column:
    return F.struct(up.alias("up"), pos.alias("pos"), single.alias("single"), v.alias("v"))


def layers_within(text: Column) -> Column:
    """As many layers as any place of a JSON text can have, where a layer is one array or one JSON text.

    Each array has its bracket, and each JSON text in a JSON text has at least one backslash of its own (so has a
    bracket that is written as an escape), which bounds the layers of the whole text and of everything inside it.
    """
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return F.coalesce(count("[") + count("\\") + 3, F.lit(0))


def spread(items: Column, layers: Column) -> Column:
    """Open JSON texts and arrays, in any order and in each other, until only objects and plain values are left.

    ``items`` is an array of :func:`item`: ``pos`` is the position in the outermost array met, 0 if there is none;
    ``single`` tells that none was met. Nulls and texts that are no JSON go. The loop has ``layers`` steps; one that
    finds nothing left to open costs nothing.
    """

    def opened_one(t: Column) -> Column:
        def by_kind(v: Column, kind: Column) -> Column:
            members = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e, i: F.struct(F.lit(False).alias("closed"), item(t["up"], F.when(t["single"], i).otherwise(t["pos"]), F.lit(False), e).alias("t")))
            one = F.array(F.struct((kind != "STRING").alias("closed"), item(t["up"], t["pos"], t["single"], v).alias("t")))
            return F.when(F.startswith(kind, F.lit("ARRAY")), members).when(v.isNotNull(), one)

        return let(unfold(t["v"]), lambda v: let(F.schema_of_variant(v), lambda kind: by_kind(v, kind)))

    def step(acc: Column, _: Column) -> Column:
        def sorted_out(found: Column) -> Column:
            pick = lambda closed: F.transform(F.filter(found, lambda x: x["closed"] if closed else ~x["closed"]), lambda x: x["t"])
            return F.struct(pick(False).alias("todo"), F.concat(acc["done"], pick(True)).alias("done"))

        return F.when(F.size(acc["todo"]) == 0, acc).otherwise(let(F.flatten(F.filter(F.transform(acc["todo"], opened_one), lambda a: a.isNotNull())), sorted_out))

    start = F.struct(items.alias("todo"), F.filter(items, lambda _: F.lit(False)).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), layers)), start, step, lambda acc: acc["done"])


def opened(df: DataFrame, text: str, tops: str, layers: str) -> DataFrame:
    """Add the payload as an array of items, with its JSON texts and arrays opened, and the bound of its layers."""
    df = settled(df, {"top_v": parse(F.col(text)), layers: layers_within(F.col(text))})
    whole_one = item(F.lit(0), F.lit(0), F.lit(True), F.col("top_v"))
    return settled(df, {tops: spread(F.array(whole_one), F.col(layers))}).drop("top_v")


def below(df: DataFrame, tops: str, layers: str, outer: str, out: str) -> DataFrame:
    """Add ``out``, the items under ``outer`` of the items ``tops``, one level down.

    ``pos`` is the position in an array under ``outer``, ``up`` that of the ancestor and ``single`` tells that no
    array stood there.
    """
    held = F.transform(tops, lambda t: item(t["pos"], F.lit(0), F.lit(True), child(t["v"], outer)))
    return settled(df, {out: spread(held, F.col(layers))})


def child(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def leaf(v: Column, name: str, clean: Callable[[Column], Column]) -> Column:
    """The cleaned text of a scalar member, null for objects and arrays."""
    return let(child(v, name), lambda x: F.when(~F.schema_of_variant(x).rlike("^(OBJECT|ARRAY|VOID)"), clean(F.try_variant_get(x, "$", "string"))))


def fid_text(text: Column) -> Column:
    return whole(text).cast("string")


def address_text(text: Column) -> Column:
    return blank_to_null(address(text))


@dataclass(frozen=True)
class Target:
    """One flat table: objects at ``path`` (one member per level) below a payload column, with scalar members as columns."""

    text: str
    path: Sequence[str]
    fields: Mapping[str, tuple[str, Callable[[Column], Column]]]

    def row(self, t: Column) -> Column:
        """The row of a child table for one item."""
        fields = [leaf(t["v"], member, clean).alias(c) for c, (member, clean) in self.fields.items()]
        return F.struct(t["up"].cast("bigint").alias("parent_no"), t["pos"].cast("bigint").alias("item_no"), *fields)

    def named_value(self, path: str) -> Callable[[Column], Column]:
        """item_no, path and value of the only field for one item."""
        ((member, clean),) = self.fields.values()
        return lambda t: F.struct(numbered(self.path, t).cast("bigint").alias("item_no"), F.lit(path).alias("path"), leaf(t["v"], member, clean).alias("value"))


def numbered(path: Sequence[str], t: Column) -> Column:
    """The position of an object among its kind: in the array at the end of the path if there is one, else that of its
    parent; for a path of two levels it is the position of the parent, which is an element of a list."""
    return t["pos"] if not path else t["up"] if len(path) > 1 else F.when(t["single"], t["up"]).otherwise(t["pos"])


def flat_tables(df: DataFrame, record_id: str, targets: Mapping[str, Target]) -> dict[str, DataFrame]:
    """One table per target: record_id, parent_no, item_no and its fields, one row per object.

    ``parent_no`` is the position of the object one level up and ``item_no`` that of the object itself, so a row of a
    child table finds its parent by (record_id, parent_no = item_no of the parent). Broken or null payloads give no
    row; absent or unusable members are null.
    """
    out = {}
    for name, target in targets.items():
        rows, last, layers = walked(df.select(F.col(record_id).alias("record_id"), F.col(target.text).alias("text")), "text", target.path)
        values = F.transform(last, target.row)
        objects = F.filter(last, lambda t: F.startswith(F.schema_of_variant(t["v"]), F.lit("OBJECT")))
        rows = settled(rows.select("record_id", last), {last: objects})
        out[name] = rows.select("record_id", F.inline(values))
    return out


def walked(rows: DataFrame, text: str, path: Sequence[str]) -> tuple[DataFrame, str, str]:
    """The rows with the items at the end of the path; the names of their column and of the bound of layers."""
    tops, layers = f"{text}_0", f"{text}_layers"
    rows = opened(rows, text, tops, layers)
    for i, outer in enumerate(path, 1):
        rows = below(rows, tops, layers, outer, f"{text}_{i}")
        rows = rows.drop(tops)
        tops = f"{text}_{i}"
    return rows, tops, layers


def values_at(df: DataFrame, table: str, record_id: str, targets: Mapping[str, Target]) -> DataFrame:
    """raw_table, record_id, item_no, path, value: one row per present value of the targets, without repeats in a record.

    The table is read once for all its targets and one ``inline`` emits their rows. Records are unique by id, so
    repeats are removed inside the record's array and nothing is shuffled. Null or broken payloads, absent members and
    unusable values give no row. ``targets`` is keyed by the path that the rows carry; each has one field.
    """
    texts = list(dict.fromkeys(t.text for t in targets.values()))
    rows = df.select(F.col(record_id).alias("record_id"), *[F.col(t).alias(f"text_{i}") for i, t in enumerate(texts)])
    found = []
    for n, (path, target) in enumerate(targets.items()):
        rows, last, layers = walked(rows, f"text_{texts.index(target.text)}", target.path)
        rows = settled(rows, {f"values_{n}": F.transform(last, target.named_value(path))}).drop(last, layers)
        found.append(F.coalesce(f"values_{n}", F.array().cast("array<struct<item_no: bigint, path: string, value: string>>")))
    kept = F.array_distinct(F.filter(F.flatten(F.array(*found)), lambda x: x["value"].isNotNull()))
    return rows.select("record_id", F.inline(kept)).select(F.lit(table).alias("raw_table"), "record_id", "item_no", "path", "value")
