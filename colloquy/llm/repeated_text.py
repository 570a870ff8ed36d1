"""Removal of repeated byte strings: suffix order of shards by induced sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere else,
in the same or another document, is removed. To bring the places where the same
string may start into one shard, each window of ``length`` bytes is assigned to
its anchor, the left-most smallest hash of its GRAM-byte substrings. Equal windows
have equal anchors at equal offsets, so only anchors that occur more than once are
of interest. Anchors whose whole surroundings are alike are settled by comparing
hashes of these; the surroundings of the others go, in four overlapping parts, to
shards, where equal parts are settled at once and the suffixes of the unlike ones are put in order by external induced sorting with common
prefixes (induced_sort), and windows that share ``length`` symbols are repeated.
Groups too large for a shard are divided first, by longer and longer cores.

Copies of whole texts are settled first, by their 128-bit hash, so that a large
group of copies costs one row for each.

Defined cases: null and empty texts have nothing to remove; texts shorter than
``length`` are left alone; a text of any length is read whole, by one task; all
places of a repeated string are removed, so there are no ties; repeated rows are
copies of each other, also with equal doc_id; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .induced_sort import suffix_order
from .staging import Stages, keep_shared

#: Parts into which the windows of an anchor are divided by their offset.
PARTS = 4
#: Bytes of a shard; it ends with the last row of a group of equal cores.
SHARD_BYTES = 2 << 20
#: Pieces of a group of equal cores that one task sorts; larger groups are divided by longer cores.
KEY_ROWS = 2_048


class Shape:
    """Sizes that follow from the length of a repeated string."""

    def __init__(self, length: int):
        self.length = length
        self.gram = min(length, max(8, length * 8 // 25))
        self.window = length - self.gram + 1  # grams of a window
        self.part = -(-self.window // PARTS)

    def last(self, j: int) -> int:
        """Largest offset of an anchor in windows of part j."""
        return min((j + 1) * self.part, self.window) - 1


def anchors(buf: np.ndarray, off: np.ndarray, shape: Shape):
    """Places of the anchors of rows at off, their hashes, and their windows' first and last start."""
    n, size, w = len(buf), shape.length, shape.window
    none = np.zeros(0, np.int64)
    if n < size:
        return none, none.astype(np.uint64), none, none
    up, down = tb.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    grams = tb.mix((total[shape.gram :] - total[: n - shape.gram + 1]) * down[: n - shape.gram + 1])
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: -(w - span)], least[w - span :])
    long = np.flatnonzero(np.diff(off) >= size)
    mark = np.zeros(n + 2, np.int32)
    np.add.at(mark, off[long], 1)
    np.add.at(mark, off[long + 1] - size + 1, -1)
    start = np.flatnonzero(np.cumsum(mark)[: n - size + 1] > 0)
    if not len(start):
        return none, none.astype(np.uint64), none, none
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    place = at[head]
    return place, grams[place], start[head], start[np.append(head[1:] - 1, len(at) - 1)]


_OCCURRENCE = "anchor long, ctx long, c0 int, c1 int, c2 int, c3 int, t1 long, t2 long, first int, last int, pos array<int>"


def _occurrences(docs: DataFrame, shape: Shape) -> DataFrame:
    def run(batches):
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            t1, t2 = (batch.column(c).to_numpy() for c in ("t1", "t2"))
            _, own = np.unique(np.stack([t1, t2]), axis=1, return_index=True)
            lone = np.zeros(len(t1), bool)
            lone[own] = True  # copies within a batch are settled by their hash
            for i, j in tb.chunks(off, SHARD_BYTES):  # some 100 bytes of arrays for each byte
                part, local = buf[off[i] : off[j]], off[i : j + 1] - off[i]
                p, gram, first, last = anchors(part, local, shape)
                row = np.searchsorted(local, p, "right") - 1
                ok = lone[i + row]
                p, gram, first, last, row = p[ok], gram[ok], first[ok], last[ok], row[ok]
                begin, end = local[row], local[row + 1]
                lo, hi = np.maximum(begin, p - shape.window + 1), np.minimum(end, p + shape.length)
                around = tb.span_hashes(part, lo, hi) ^ tb.mix((p - lo).astype(np.uint64))
                up, down = tb.powers(len(part) + 1)
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
                cores = []
                for k in range(PARTS):
                    small, large = k * shape.part, shape.last(k)
                    has = (np.maximum(small, p - last) <= np.minimum(large, p - first)) & (large >= small)
                    a, b = np.where(has, p - small, p), np.where(has, p - large + shape.length, p)
                    h = (tb.mix((total[b] - total[a]) * down[a]) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                    cores.append(np.where(has, h, np.uint32(0)).view(np.int32))
                # one row for the first place of equal surroundings in a text, and one for its other places
                order = np.lexsort((p, around, gram, row))
                new = np.append(True, (row[order][1:] != row[order][:-1]) | (gram[order][1:] != gram[order][:-1]) | (around[order][1:] != around[order][:-1]))[: len(order)]
                heads = np.flatnonzero(new)
                several = heads[np.diff(np.append(heads, len(order))) > 1]
                starts = np.sort(np.concatenate([heads, several + 1]))
                at = order[starts]
                columns = [gram[at].view(np.int64), around[at].view(np.int64), *(c[at] for c in cores), t1[i + row[at]], t2[i + row[at]], *((x[at] - p[at]).astype(np.int32) for x in (first, last))]
                places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), pa.array((p - begin)[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), places], [f.split()[0] for f in _OCCURRENCE.split(", ")])

    return docs.select("t1", "t2", "text").mapInArrow(run, _OCCURRENCE)


def flagged(strings: list[bytes], first: np.ndarray, last: np.ndarray, length: int, folder: str | None = None) -> list[np.ndarray]:
    """For each string the starts, of those from first to last, of windows that start elsewhere too."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1)
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + np.uint16(2)
    text[ends - 1] = 1
    begins = ends - sizes - 1
    order, common = suffix_order(text, length, folder=folder)
    mark = np.zeros(len(text) + 1, np.int32)
    some = last >= first
    np.add.at(mark, (begins + first)[some], 1)
    np.add.at(mark, (begins + last)[some] + 1, -1)
    mine = np.cumsum(mark)[:-1] > 0
    group = np.cumsum(common < length)
    own = mine[order]
    repeated = own & (np.bincount(group[own], minlength=group[-1] + 1 if len(group) else 1)[group] > 1)
    hit = np.zeros(len(text), bool)
    hit[order[repeated]] = True
    at = np.flatnonzero(hit)
    cut = np.searchsorted(at, np.append(begins, len(text)))
    return [at[a:b] - s for a, b, s in zip(cut, cut[1:], begins)]


def cover(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows of that length at sorted starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.append(0, cut)], starts[np.append(cut - 1, len(starts) - 1)] + length


_PIECE = ["key", "anchor", "ctx", "times", "bytes", "lo", "first", "last"]


def _sorted_marks(pieces: DataFrame, shape: Shape) -> DataFrame:
    """(anchor, ctx, a, b): covered runs, relative to the anchor, of pieces sorted in shards."""

    def run(batches):
        rows, held, key = [], 0, None

        def solve():
            alike = {}  # rows by key, place of the anchor and bytes: equal pieces have equal windows
            for r in rows:
                alike.setdefault((r[0], r[4], r[3]), []).append(r)
            distinct = Counter(k for k, _, _ in alike)
            unlike = [of for (k, _, _), of in alike.items() if distinct[k] > 1]
            first = np.array([of[0][5] - of[0][4] for of in unlike], np.int64)
            last = np.array([of[0][6] - of[0][4] for of in unlike], np.int64)
            found = flagged([of[0][3] for of in unlike], first, last, shape.length) if unlike else []
            out = {c: [] for c in ("anchor", "ctx", "a", "b")}
            starts = {id(of): s + of[0][4] for of, s in zip(unlike, found)}
            for of in alike.values():
                at = np.arange(of[0][5], of[0][6] + 1) if len(of) > 1 else starts.get(id(of), ())
                runs = list(zip(*cover(np.asarray(at, np.int64), shape.length)))
                for r in of:
                    if r[7] > 1:
                        continue  # its whole surroundings are marked already
                    for a, b in runs:
                        for c, v in zip(out, (r[1], r[2], a, b)):
                            out[c].append(int(v))
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], list(out))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "anchor", "ctx", "bytes", "lo", "first", "last", "times"))):
                if held >= SHARD_BYTES and row[0] != key:
                    yield solve()
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
                key = row[0]
        if rows:
            yield solve()

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(run, "anchor long, ctx long, a int, b int")


def _divided_marks(pieces: DataFrame, shape: Shape, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Marks of equal pieces of large groups, and the unlike pieces left, in groups of at most KEY_ROWS.

    One piece of each kind stays as the others' partner. While a group has too many
    kinds, its pieces are cut in four by their windows' starts, and what were equal
    cores becomes equal longer cores; where a single start is left, the core is the
    whole window. So nothing is lost and no task holds a group of any size.
    """
    marks, small = [], []
    width = shape.part
    text = lambda *columns: F.concat(*(F.concat(F.col(c).cast("string"), F.lit(" ")).cast("binary") for c in columns), F.col("bytes"))
    while True:
        pieces = stages.keep(pieces.withColumn("kind", F.sha2(text("key", "lo"), 256)), "pieces")
        equal = keep_shared(pieces.select("kind", "anchor", "ctx", "times", "first", "last"), "kind", ["ctx"])
        marks.append(stages.keep(equal.where("times = 1").select("anchor", "ctx", F.col("first").alias("a"), (F.col("last") + shape.length).cast("int").alias("b")), "marks"))
        kinds = pieces.groupBy("key", "anchor", "kind", "bytes", "lo", "first", "last", "s0", "s1").agg(F.min("ctx").alias("ctx"), F.greatest(F.max("times"), F.count("*")).alias("times"))
        kinds = stages.keep(kinds, "kinds")
        stages.drop(pieces)
        sizes = stages.keep(kinds.groupBy("key").count().where("count > 1"), "sizes")
        small.append(kinds.join(sizes.where(F.col("count") <= KEY_ROWS), "key", "left_semi").select(*_PIECE))
        large = sizes.where(F.col("count") > KEY_ROWS)
        if width == 1 or large.isEmpty():
            break
        width = -(-width // 4)
        cut = kinds.join(large, "key", "left_semi").withColumn("a", F.explode(F.sequence("s0", "s1", F.lit(width)))).withColumn("b", F.least(F.col("a") + width - 1, "s1"))
        cut = cut.where(F.greatest("first", "a") <= F.least("last", "b")).withColumn("from", F.greatest("lo", "a"))
        core = F.expr(f"substring(bytes, b - lo + 1, a + {shape.length} - b)")
        cut = cut.withColumns({"key": F.xxhash64("key", "a", core), "bytes": F.expr(f"substring(bytes, from - lo + 1, b + {shape.length} - from)"), "lo": F.col("from"), "first": F.greatest("first", "a"), "last": F.least("last", "b"), "s0": F.col("a"), "s1": F.col("b")})
        pieces = keep_shared(cut.drop("a", "b", "from"), "key", ["kind"])
    return reduce(DataFrame.unionByName, marks), reduce(DataFrame.unionByName, small)


def with_hash(docs: DataFrame) -> DataFrame:
    """docs with text null made empty and its 128-bit hash t1, t2."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(71), F.col("text"))})


def repeated_spans(docs: DataFrame, length: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Copied texts (t1, t2), and of other texts the spans (t1, t2, spans) to remove.

    docs: doc_id, text, t1, t2. Spans may overlap and reach beyond the text.
    """
    shape = Shape(length)
    texts = stages.keep(docs.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")), "texts")
    copied = texts.where("n > 1").select("t1", "t2")
    found = stages.keep(keep_shared(_occurrences(docs, shape), "anchor", ["t1", "t2", "ctx"]), "occurrences")
    rep = F.min(F.struct("t1", "t2", F.col("pos")[0].alias("pos"), "first", "last", "c0", "c1", "c2", "c3")).alias("rep")
    around = stages.keep(found.groupBy("anchor", "ctx").agg(F.count("*").alias("n"), rep), "surroundings")
    run = lambda a, b: F.array(F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))
    alike = around.where("n > 1").select("anchor", "ctx", run(F.lit(1 - shape.window), F.lit(length)).alias("runs"))

    varied = keep_shared(around.select("anchor", "ctx", F.col("n").alias("times"), "rep.*"), "anchor", ["ctx"])
    cores = varied.select("anchor", "ctx", "times", "t1", "t2", "pos", "first", "last", F.posexplode(F.array("c0", "c1", "c2", "c3")).alias("part", "core")).where("core <> 0")
    cores = stages.keep(keep_shared(cores.withColumn("key", F.xxhash64("anchor", "part", "core")), "key"), "cores")
    hot = stages.keep(cores.groupBy("key").count().where(F.col("count") > KEY_ROWS).select("key"), "hot")
    small = F.col("part") * shape.part
    large = F.least((F.col("part") + 1) * shape.part, F.lit(shape.window)) - 1
    cores = cores.withColumns({"lo": F.greatest(-large, -F.col("pos")), "hi": length - small})
    cores = cores.withColumns({"first": F.greatest("first", "lo"), "last": F.least("last", -small)})
    cores = cores.join(texts.select("t1", "t2", F.coalesce("doc_id", F.lit(-(2**63))).alias("row")), ["t1", "t2"])
    whole = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("row"), "t1", "t2", F.col("text").cast("binary").alias("raw"))
    cores = cores.withColumns({"s0": -large, "s1": -small})
    columns = [*_PIECE, "s0", "s1"]

    def pieces(of: DataFrame) -> DataFrame:
        return of.join(whole, ["row", "t1", "t2"]).withColumn("bytes", F.expr("substring(raw, pos + lo + 1, hi - lo)")).select(*columns)

    if hot.isEmpty():
        marks = stages.keep(_sorted_marks(pieces(cores).select(*_PIECE), shape), "marks")
    else:
        settled, unlike = _divided_marks(pieces(cores.join(hot, "key", "left_semi")), shape, stages)
        rest = pieces(cores.join(hot, "key", "left_anti")).select(*_PIECE)
        marks = stages.keep(_sorted_marks(rest.unionByName(unlike), shape), "marks").unionByName(settled)
    marks = marks.groupBy("anchor", "ctx").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    moved = F.flatten(F.transform("pos", lambda p: F.transform("runs", lambda r: F.struct((p + r.a).alias("a"), (p + r.b).alias("b")))))
    spans = found.join(marks.unionByName(alike), ["anchor", "ctx"]).select("t1", "t2", moved.alias("spans"))
    spans = spans.join(copied, ["t1", "t2"], "left_anti")
    copied = stages.keep(copied, "copied")
    spans = stages.keep(spans.groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    stages.only("copied", "spans")
    return copied, spans


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((max(0, s["a"]), min(size, s["b"])) for s in spans):
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_repeats(docs: DataFrame, length: int = 400, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs.

    With with_text, all columns of docs are kept, text is what remains, and the
    figures and ``removed``, the removed byte ranges (start, end), are added. Where a
    range ends inside a character, the bytes left of it are in kept_sha256 only,
    since they are no text.
    """
    stages = Stages(docs.sparkSession)
    figures = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["removed"] if with_text else [])]
    own = [c for c in docs.columns if c not in ("t1", "t2", "spans", "copied", *figures)] if with_text else ["doc_id"]
    docs = with_hash(docs.withColumn("doc_id", F.col("doc_id").cast("long")).select(*dict.fromkeys(["doc_id", "text", *own])))
    copied, spans = repeated_spans(docs, length, stages)
    joined = docs.join(copied.withColumn("copied", F.lit(True)), ["t1", "t2"], "left").join(spans, ["t1", "t2"], "left")
    joined = joined.withColumn("n_bytes", F.octet_length("text").cast("long"))
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= length)
    ranges = "array<struct<start:long,end:long>>"

    def run(batches):
        for batch in batches:
            buf, off = tb.as_bytes(batch.column("text"))
            removed, count, digest, kept, cuts = [], [], [], [], []
            for r, s in enumerate(batch.column("spans").to_pylist()):
                raw = buf[off[r] : off[r + 1]].tobytes()
                runs = _merged(s, len(raw))
                edges = [0, *(x for ab in runs for x in ab), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                removed.append(len(raw) - len(rest))
                count.append(len(runs))
                digest.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest.decode("utf-8", "ignore"))
                    cuts.append([{"start": a, "end": b} for a, b in runs])
            new = {"n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(count, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
            if with_text:
                new["text"] = pa.array(kept, pa.string())
                new["removed"] = pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    names = [*own, *figures]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*own, "n_bytes").schema) + ", n_removed long, n_spans long, kept_sha256 string" + f", removed {ranges}" * with_text
    touched = joined.where(F.col("spans").isNotNull() & ~gone)
    cut = touched.select(*dict.fromkeys(["text", *own, "n_bytes", "spans"])).mapInArrow(run, schema)
    rest = joined.where(F.col("spans").isNull() | gone)
    whole = F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.array().cast(ranges))
    rest = rest.withColumn("removed", whole)
    if with_text:
        rest = rest.withColumn("text", F.when(gone, F.lit("")).otherwise(F.col("text")))
    sha = F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.sha2("text", 256))
    rest = rest.select(*own, "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.lit(0)).alias("n_removed"), gone.cast("long").alias("n_spans"), sha.alias("kept_sha256"), *(["removed"] if with_text else []))
    return cut.unionByName(rest)
