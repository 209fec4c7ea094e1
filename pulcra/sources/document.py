"""One JSON document read by many tasks.

The text is read in fragments that end at a closing brace, so a file of one line is split like any
other. Whether a split starts inside a text, and at which depth of the document, follows from the
sums over the splits before it: quotes first, then brackets outside of texts. A first pass takes one
row of sums a split, for both cases; a second one starts each split where those say and puts the
fragments of a row together in the order in which it reads them, so the text is neither shuffled nor
sorted. A brace that leads back to depth two ends a row of an array of the document; rows are written
as lines, one folder per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterator, Mapping
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.operators.lookup import materialize, work_folder

# A text of JSON; what lies before the first opening brace outside of texts; texts with what makes
# them keys.
_TEXT = r'"(?:[^"\\]++|\\.)*+"'
_BEFORE_OBJECT = rf'(?s)^((?:[^"{{]++|{_TEXT})*+)'
_KEY = rf"(?s)({_TEXT})(\s*:\s*[\[{{]?)?"
MOST_KEYS = 10_000  # of a document; they are looked at by the driver


class Document(NamedTuple):
    """``keys`` of a document with the bracket that opens their value, if any; ``lines`` has the path
    of the JSON lines of each wanted table that has rows."""

    keys: dict[str, str]
    lines: dict[str, str]


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """``value, _block``: what lies before each closing brace, in the order of each split."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("_block"))


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """Each batch as one text per split, its braces put back."""
    for batch in batches:
        blocks, values = batch.column(1).to_numpy(), batch.column(0)
        ends = [*(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
        for start, end in zip([0, *ends], ends):
            if end > start:
                yield int(blocks[start]), b"}".join([*values.slice(start, end - start).to_pylist(), b""])


def _marks(text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of brackets; whether an odd number of quotes precedes each; the number of quotes."""
    data = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(data == 34)
    if b"\\" in text:  # a quote behind an odd run of backslashes is part of a text
        other = np.maximum.accumulate(np.where(data != 92, np.arange(len(data)), -1))
        before = np.where(quotes > 0, other[np.maximum(quotes - 1, 0)], -1)
        quotes = quotes[(quotes - before) % 2 == 1]
    # Square brackets and braces differ in this one bit.
    found = np.flatnonzero(((data | 32) == 123) | ((data | 32) == 125))
    return found, np.searchsorted(quotes, found) % 2 == 1, len(quotes)


def _steps(text: bytes, places: np.ndarray) -> np.ndarray:
    """One up for an opening bracket, one down for a closing one."""
    return np.where((np.frombuffer(text, np.uint8)[places] | 32) == 123, 1, -1)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, quotes, outside, inside``: quotes of a split, and the change of depth in it if it
    starts outside or inside of a text."""
    for block, texts in groupby(_by_block(batches), lambda x: x[0]):
        quotes = outside = inside = 0
        for _, text in texts:
            places, odd, n = _marks(text)
            odd, steps = odd ^ (quotes % 2 == 1), _steps(text, places)
            outside, inside = outside + int(steps[~odd].sum()), inside + int(steps[odd].sum())
            quotes += n
        yield pa.record_batch({"block": [block], "quotes": [quotes], "outside": [outside], "inside": [inside]})


def _pieces(starts: Mapping[int, tuple[int, int]]):
    """``block, at, cut, depth, after, text``: fragments from one cut to the next put together. The
    last piece of a split may go on in the next one and has no ``cut`` then."""
    schema = pa.schema([("block", pa.int64()), ("at", pa.int64()), ("cut", pa.bool_()), ("depth", pa.int64()), ("after", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in groupby(_by_block(batches), lambda x: x[0]):
            quotes, depth = starts[block]
            at, first, open_text = 0, depth, []  # of the piece that is not yet cut
            for _, text in texts:
                places, odd, n = _marks(text)
                outside = odd == (quotes % 2 == 1)
                places = places[outside]
                depths = depth + np.cumsum(_steps(text, places))
                ends = (np.frombuffer(text, np.uint8)[places] == 125) & (depths <= 2)
                cuts, after = places[ends].tolist(), depths[ends]
                quotes, depth = quotes + n, int(depths[-1]) if len(depths) else depth
                if cuts:
                    own = [text[a + 1 : b] for a, b in zip([-1, *cuts], cuts)]
                    own[0] = b"".join([*open_text, own[0]])
                    before = np.concatenate([[first], after[:-1]])
                    yield pa.record_batch([np.full(len(cuts), block), np.arange(at, at + len(cuts)), np.ones(len(cuts), bool), before, after, pa.array(own, pa.binary())], schema=schema)
                    at, first, open_text = at + len(cuts), int(after[-1]), []
                if rest := text[cuts[-1] + 1 :] if cuts else text:
                    open_text.append(rest)
            if open_text:
                yield pa.record_batch([[block], [at], [False], [first], [depth], [b"".join(open_text)[:-1]]], schema=schema)

    return run


def _joined(spark: SparkSession, path: str) -> DataFrame:
    """``group, depth, after, text``: the pieces, those that go on in another split put together.

    What the driver sees is a row of sums for each split of the file.
    """
    given = fragments(spark, path)
    sums = given.mapInArrow(_block_sums, "block long, quotes long, outside long, inside long").collect()
    starts, quotes, depth = {}, 0, 0
    for row in sorted(sums):
        starts[row["block"]] = quotes, depth
        depth += row["inside"] if quotes % 2 else row["outside"]
        quotes += row["quotes"]
    kinds = "block long, at long, cut boolean, depth long, after long, text binary"
    pieces = materialize(given.mapInArrow(_pieces(starts), kinds).withColumn("text", F.col("text").cast("string")))
    cuts = dict(pieces.where("cut").groupBy("block").count().collect())
    bases, base = [], 0
    for block in sorted(starts):
        bases.append((block, base))
        base += cuts.get(block, 0)
    few = F.broadcast(spark.createDataFrame(bases, "block long, base long"))
    pieces = pieces.join(few, "block").withColumn("group", F.col("base") + F.col("at"))
    across = (F.col("at") == 0) | ~F.col("cut")  # at most two pieces of a split
    piece = F.struct("block", "at", "text", "depth", "after")
    groups = pieces.where(across).groupBy("group").agg(F.sort_array(F.collect_list(piece)).alias("p"))  # of one row object
    text = F.array_join(F.transform("p", lambda x: x["text"]), "}")
    groups = groups.select("group", F.col("p")[0]["depth"].alias("depth"), F.element_at("p", -1)["after"].alias("after"), text.alias("text"))
    return pieces.where(~across).select("group", "depth", "after", "text").unionByName(groups)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """``group, depth, after, opened, head, row``, written: the fragments from one cut to the next put
    together. A cut lies behind a brace that ends a row, a key's object or the document. ``head`` is
    what stands before the group's first object, ``row`` the rest without its last brace."""
    groups = _joined(spark, path)
    # The document's own brace and blanks before it are no part of the first group.
    start = F.regexp_replace("text", r"(?s)^[\x{FEFF}\s]+", "")
    first = F.col("group") == 0
    body = F.when(first, start.substr(F.lit(2), F.char_length("text"))).otherwise(F.col("text"))
    groups = groups.select("group", "depth", "after", F.when(first, F.substring(start, 1, 1)).alias("opened"), body.alias("body"))
    plain = F.substring_index("body", "{", 1)
    head = F.when(F.contains(plain, F.lit('"')), F.regexp_extract("body", _BEFORE_OBJECT, 1)).otherwise(plain)
    groups = groups.withColumn("head", head)
    row = F.col("body").substr(F.char_length("head") + 1, F.char_length("body"))
    return materialize(groups.select("group", "depth", "after", "opened", "head", row.alias("row")))


def _check_ends(groups: DataFrame) -> None:
    """One brace opens the document and one closes it; only blanks follow."""
    seen = groups.agg(F.max("group").alias("last"), F.count(F.when(F.col("after") <= 0, 1)).alias("closings")).first()
    ends = {r["group"]: r for r in groups.where(F.col("group").isin(0, seen["last"] or 0)).collect()}
    last = ends.get(seen["last"])
    blank = last is not None and last["depth"] == 0 and not (last["head"] + last["row"]).strip()
    if last is None or ends[0]["opened"] != "{" or seen["closings"] != 1 + blank or not (blank or last["after"] == 0):
        raise ValueError("the document must be one JSON object with a key per table")


def _keys_and_starts(groups: DataFrame) -> tuple[dict[str, str], list[tuple[int, str | None]]]:
    """Keys of the document; groups with keys, and the key if an array of objects starts there."""
    bare = F.regexp_replace("head", _TEXT, "")
    # A key of the document stands where a group starts at its level or leaves an array.
    level = (F.col("depth") < 2) | F.contains(bare, F.lit("]"))
    names, opens = (F.regexp_extract_all("head", F.lit(_KEY), F.lit(k)) for k in (1, 2))
    heads = groups.where(level).select("group", names.alias("names"), opens.alias("opens"), F.col("head").rlike(r"\[\s*$").alias("array"), (F.col("row") != "").alias("object"))
    heads = heads.where(F.exists("opens", lambda x: x != "")).orderBy("group").limit(MOST_KEYS + 1).collect()
    if len(heads) > MOST_KEYS:
        raise ValueError(f"the document has more than {MOST_KEYS} keys")
    keys: dict[str, str] = {}
    starts: list[tuple[int, str | None]] = []
    for head in heads:
        found = [(json.loads(name), after.strip(": \t\r\n")) for name, after in zip(head["names"], head["opens"]) if after]
        keys |= dict(found)
        name, bracket = found[-1]
        if head["object"] and not bracket:
            keys[name] = "{"
        starts.append((head["group"], name if head["object"] and head["array"] and bracket == "[" else None))
    return keys, starts


def split_document(spark: SparkSession, path: str, wanted: Collection[str]) -> Document:
    """Write the row objects of the wanted tables as JSON lines: ``place`` in the array, ``row``."""
    # Names and lengths only: as text, a file of one line would be read by each of its splits to the end.
    if spark.read.format("binaryFile").load(path).where("length > 0").select("path").limit(2).count() > 1:
        raise ValueError("a document is one file; use read_tables for folders")
    groups = row_groups(spark, path)
    _check_ends(groups)
    keys, starts = _keys_and_starts(groups)
    lines: dict[str, str] = {}
    for k, (group, name) in enumerate(starts):
        if name not in wanted:
            continue
        if name in lines:
            raise ValueError(f"table {name!r} occurs twice")
        rows = groups.where((F.col("group") >= group) & (F.col("after") == 2))
        if k + 1 < len(starts):
            rows = rows.where(F.col("group") < starts[k + 1][0])
        between = (F.col("group") > group) & ~F.col("head").rlike(r"^\s*,\s*$")
        # No text of JSON holds a line break, so those between its tokens may become blanks.
        whole = F.regexp_replace("row", r"[\r\n]+", " ")
        place = (F.col("group") - group).cast("string")
        line = F.concat(F.lit('{"place":'), place, F.lit(',"row":'), whole, F.lit("}}"))
        lines[name] = f"{work_folder(spark)}/{uuid.uuid4().hex}"
        seen = Observation()
        odd = F.count(F.when(between, 1)).alias("odd")
        rows.observe(seen, odd).select(line.alias("value")).write.text(lines[name])
        if seen.get["odd"]:
            raise ValueError(f"table {name!r} must be an array of row objects")
    for name in set(wanted) & set(keys):
        if keys[name] != "[":
            raise ValueError(f"table {name!r} must be an array of row objects")
    return Document(keys, lines)


def read_rows(spark: SparkSession, document: Document, table: str) -> DataFrame:
    """``place, row`` of one table, primitives as text."""
    rows = spark.read.json(document.lines[table], primitivesAsString=True)
    if "_corrupt_record" in rows.columns or not isinstance(rows.schema["row"].dataType, T.StructType):
        raise ValueError(f"table {table!r} holds rows that are no JSON objects")
    return rows
