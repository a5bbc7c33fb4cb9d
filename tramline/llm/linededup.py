"""Line dedup over range-partitioned hashes, returning keep bitmaps."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.shared import ascii_lower, checked, lean, ranked, saved, unused

#: Stands for a null doc_id in keys; it is the smallest id, so such a document keeps a line only if no other has it.
NO_ID = -(1 << 63)
OUT = "kind int, h1 long, h2 long, doc long, row long, n long"


def line_keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """h1, h2, doc, row, pos for each line whose key has at least `least_chars` code points. The key is the line
    without white space at its ends, A-Z lower-cased; 128 bits of two hashes stand for it. `row` is the hash of the
    text, so that rows that share an id don't mix. doc_id has to be an integer; other ids go through `numbered`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"))
    lines = base.select("doc", "row", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.select("doc", "row", "pos", F.btrim("line", F.lit(" \t\n\x0b\x0c\r")).alias("line")).where(F.char_length("line") >= least_chars)
    key = ascii_lower(F.col("line"))
    return lines.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"), "doc", "row", F.col("pos").cast("long").alias("pos"))


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with doc_id replaced by its place in ascending order where it isn't an integer, so that the
    largest id is still the largest; nulls stay null, equal ids equal."""
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return docs
    ids = ranked(docs.select("doc_id").where("doc_id IS NOT NULL").distinct(), ["doc_id"]).select(F.col("doc_id").alias("n_id"), F.col("rank").alias("n_rank"))
    kept = [F.col(f"d.`{c}`") if c != "doc_id" else F.col("n.n_rank").alias("doc_id") for c in docs.columns]
    return docs.alias("d").join(ids.alias("n"), F.col("d.doc_id") == F.col("n.n_id"), "left").select(*kept)


def _emit(kind, h1, h2, doc, row, n):
    size = len(doc)
    full = lambda x: np.broadcast_to(np.asarray(x, np.int64), size)
    return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *(pa.array(np.ascontiguousarray(full(x))) for x in (h1, h2, doc, row, n))], names=["kind", "h1", "h2", "doc", "row", "n"])


def _stream(least_docs: int):
    """Reads a partition sorted by (h1, h2, doc descending, row, pos) and decides each run of one hash that lies
    inside it: kind 0 rows are lines to drop (n: position). The first and the last run may go on in a neighbouring
    partition: kind 1 rows are their lines, kind 2 rows their number of documents (n) and largest document."""

    def decide(cols, edge):
        h1, h2, doc, row, pos = cols
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        docs = np.bincount(run, weights=np.r_[True, new[1:] | (doc[1:] != doc[:-1])]).astype(np.int64)
        if edge:  # one run alone
            return [_emit(1, h1, h2, doc, row, pos), _emit(2, h1[:1], h2[:1], doc[:1], row[:1], docs[:1])]
        out = (docs[run] >= least_docs) & (doc != doc[start][run])
        return [_emit(0, h1[out], h2[out], doc[out], row[out], pos[out])]

    def runs(batches):
        held, first = [], True  # the parts of the run that isn't over yet, joined once when it is
        whole = lambda: [np.concatenate(x) for x in zip(*held, strict=True)]
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if not len(cols[0]):
                continue
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
            if held and (cols[0][0] != held[-1][0][-1] or cols[1][0] != held[-1][1][-1]):
                yield from decide(whole(), first)
                held, first = [], False
            if not len(new):
                held.append(cols)
                continue
            held.append([x[: new[0]] for x in cols])
            yield from decide(whole(), first)
            first = False
            if new[0] < new[-1]:
                yield from decide([x[new[0] : new[-1]] for x in cols], False)
            held = [[x[new[-1] :] for x in cols]]
        if held:
            yield from decide(whole(), True)

    return runs


def dropped_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc, row, pos of each line that goes: its key is in at least `least_docs` documents, of which this is not the
    one with the largest id. Hashes are dealt by range over (hash, document), so that the lines of one very common
    key spread over many tasks; sorted by hash, then document and position, a task streams them and meets the
    occurrence that stays first. Only the runs at the ends of partitions wait for a table of two rows a partition."""
    lines = line_keys(docs, least_chars)
    dealt = lines.withColumn("back", -1 - F.col("doc")).repartitionByRange("h1", "h2", "back")
    dealt = dealt.sortWithinPartitions("h1", "h2", "back", "row", "pos").select("h1", "h2", "doc", "row", "pos")
    out = saved(dealt.mapInArrow(lean(_stream(least_docs)), OUT))
    ends = out.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("docs"), F.max("doc").alias("keeper")).where(F.col("docs") >= least_docs)
    late = out.where("kind = 1").join(checked(ends), ["h1", "h2"]).where("doc <> keeper")
    cols = ["doc", "row", F.col("n").alias("pos")]
    return out.where("kind = 0").select(*cols).unionByName(late.select(*cols))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc, row, dropped, bitmap for each document that loses lines: bit i of the zlib-compressed bitmap is 1 if
    line i goes, counted from the lowest bit of the first byte; lines past its end stay."""

    def pack(batches):
        for b in batches:
            maps, n = [], []
            for pos in b.column(2).to_pylist():
                bits = np.zeros(max(pos) + 1, np.uint8)
                bits[pos] = 1
                n.append(int(bits.sum()))
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(maps, pa.binary())], names=["doc", "row", "dropped", "bitmap"])

    per = dropped_lines(docs, least_chars, least_docs).groupBy("doc", "row").agg(F.collect_set("pos").alias("pos"))
    return per.mapInArrow(lean(pack), "doc long, row long, dropped long, bitmap binary")


def deduped(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents' columns, whatever their names, with `text` after dedup, and two more named by `counts`: lines
    before and lines dropped. A text that loses nothing stays as it is; null and empty texts are one empty line and lose
    nothing. Rows that repeat id and text are one document, and so are all without an id that share a text. Very
    long texts are read whole; no documents give none. Ids may be of any type that has an order."""
    number = not isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    if number:  # ids by rank, the given ones in a column aside
        aside = unused("given_id", docs)
        docs = numbered(docs.withColumn(aside, F.col("doc_id")))
    maps = keep_bitmaps(docs, least_chars, least_docs).withColumnsRenamed({"doc": "m_doc", "row": "m_row", "dropped": "m_cut", "bitmap": "m_bitmap"})
    text = F.coalesce(F.col("d.text"), F.lit(""))
    same = (F.coalesce(F.col("d.doc_id").cast("long"), F.lit(NO_ID)) == F.col("m.m_doc")) & (F.xxhash64(text) == F.col("m.m_row"))
    given = docs.columns
    bitmap, cut, total = (unused(n, docs) for n in ("bitmap", "cut", "lines"))
    lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1
    both = docs.alias("d").join(maps.alias("m"), same, "left")
    both = both.select(*[F.col(f"d.`{c}`") for c in given], F.col("m.m_bitmap").alias(bitmap), F.coalesce("m.m_cut", F.lit(0)).cast("long").alias(cut), lines.cast("long").alias(total))

    def apply(texts, maps):
        for text, packed in zip(texts.to_pylist(), maps.to_pylist(), strict=True):
            if packed is None:
                yield text
                continue
            bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")
            yield "\n".join(x for i, x in enumerate(text.split("\n")) if i >= len(bits) or not bits[i])

    def kept(batches):
        for b in batches:
            at = {n: i for i, n in enumerate(b.schema.names)}
            cols = [b.column(at[c]) for c in [*given, total, cut]]
            cols[given.index("text")] = pa.array(apply(b.column(at["text"]), b.column(at[bitmap])), pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[*given, total, cut])

    schema = T.StructType([*docs.schema.fields, T.StructField(total, T.LongType()), T.StructField(cut, T.LongType())])
    out = both.mapInArrow(lean(kept), schema)
    if number:
        out = out.drop("doc_id").withColumnRenamed(aside, "doc_id").select(*[c for c in given if c != aside], total, cut)
    return out.withColumnsRenamed({total: counts[0], cut: counts[1]}) if counts else out.drop(total, cut)


def summary(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for each document; null and empty texts are one empty line, all other
    cases as in `deduped`."""
    out = deduped(docs.select("doc_id", "text"), least_chars, least_docs, ("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
