"""Hard negatives by zone maps over Hilbert-ordered blocks.

Index.  Vectors become integers (floor of SCALE times each component).  Rows are
sorted by label and place on a Hilbert curve through the principal axes of a
bounded sample, and cut into blocks of BLOCK rows of one label, written as Parquet:
ids and vectors packed, and the least and greatest value of every dimension, the
block's zone map.  The sample only shapes the order; every row is indexed.

Search.  Anchors of one label stand in groups of neighbours.  Interval arithmetic
on a zone map gives the least and the greatest score that a row of the block can
have with an anchor, so a block must be read only if these bounds reach into a
window that is still open:

1. Positives.  SEEDS promising blocks of the anchor's label give a lower bound of
   its last positive's score; then all blocks of the label whose upper bound reaches
   it are read.
2. Negatives.  Each positive opens a window of scores.  SEEDS blocks of other labels
   near its upper end give a lower bound of the last negative wanted; then all blocks
   whose bounds reach between that and the window's end are read.

Bounds hold for every row, so results are exact whatever the order and the seeds; a
block that is read puts out at most the wanted number of rows per window, and the
best are kept by partial and final ranking.  Zone maps are dealt in pages to every
group of anchors (a stated query set against all rows, in blocks); blocks and groups
meet in a join by block.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite
component (also after scaling) take no part; rows with one id count once, as the one
with the smallest label and vector; shorter vectors count as ended by zeros, empty ones
score 0; ties go by smaller id; an anchor without positives, or with none in its
windows, gives no rows; an empty table gives no rows; extra columns are ignored and may
have any names.  Scores are exact integers while they and the sums that make them stay
below 2^53; larger ones are rounded to doubles and held within 64 bits."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions.ordinals import with_ordinal
from forgeline.llm.common import cut, task_count
from forgeline.session import ensure_checkpoint_dir

SCALE = 256
BLOCK = 512  # rows of a block
GROUP = 128  # anchors searched together
PAGE = 2_048  # zone maps of a page
SEEDS = 8  # blocks per page that are read first
SAMPLE = 10_000  # rows that shape the order (those with the smallest id hashes)
AXES, BITS = 7, 9  # of the Hilbert curve: 63 bits
EXACT = float(1 << 53)
SLACK = 1e-12  # of the sums in a bound, for scores beyond EXACT


# -- order -------------------------------------------------------------------------

def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below 2^bits, by the
    transposed form: undo the rotations from the top bit down, Gray-encode, then
    interleave the bits."""
    x = [c.copy() for c in cells.T.astype(np.int64)]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            turned = (x[i] >> b & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where(x[-1] >> b & 1, flip ^ ((1 << b) - 1), flip)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] ^ flip) >> b & 1)
    return key


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers, cut or ended by zeros at ``width``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = col < width
    out[row[some], col[some]] = flat[some]
    return out


def axes_of(rows: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Principal axes of a bounded sample, and the cells' limits along each."""
    told = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()  # at most ``sample`` rows
    column = told.column(0).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    width = max(int(column.value_lengths().to_numpy(zero_copy_only=False).max()) if len(column) else 0, 1)
    x = _matrix(column, width)
    spread = (x - x.mean(0)).T @ (x - x.mean(0)) if len(x) else np.eye(width)
    axes = np.linalg.eigh(spread / max(float(np.abs(spread).max()), 1.0))[1][:, ::-1][:, :AXES]
    axes = np.pad(axes, ((0, 0), (0, AXES - axes.shape[1])))
    limits = np.quantile(x @ axes, np.arange(1, 1 << BITS) / (1 << BITS), axis=0) if len(x) else np.zeros(((1 << BITS) - 1, AXES))
    return axes, limits


# -- index --------------------------------------------------------------------------

def take_part(rows: DataFrame, id_col: Column, vector: Column, label: Column, asks: Column) -> DataFrame:
    """(id, label, vector, asks) of the rows that take part, one per id."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < float("inf"))
    told = rows.select(id_col.cast("long").alias("id"), label.alias("label"), vector.cast("array<double>").alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    told = told.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", usable))
    one = told.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"), F.max("asks").alias("asks"))
    return one.select("id", "row.label", "row.vector", "asks")


def _pack(x: np.ndarray) -> bytes:
    """Rows as 32-bit floats where those are exact, else as 64-bit floats."""
    small = x.astype("<f4")
    return small.tobytes() if (small == x).all() else x.tobytes()


def _unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * n * width else "<f8").reshape(n, width).astype(np.float64)


BLOCK_DDL = "label string, n int, width int, ids binary, asks binary, vectors binary, low array<double>, high array<double>"


def write_blocks(rows: DataFrame, folder: str) -> DataFrame:
    """The blocks of (id, label, vector, asks) rows, written and read again."""
    axes, limits = axes_of(rows)
    shared = rows.sparkSession.sparkContext.broadcast((axes, limits))  # of fixed size

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, limits = shared.value
        for batch in batches:
            if batch.num_rows:
                along = _matrix(batch.column("vector"), len(axes)) @ axes
                cells = np.stack([np.searchsorted(limits[:, i], along[:, i], "right") for i in range(AXES)], 1)
                yield batch.append_column("place", pa.array(hilbert(cells)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, label = [], 0, None

        def told() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            vectors = whole.column("vector").chunk(0)
            width = int(vectors.value_lengths().to_numpy(zero_copy_only=False).max())
            x = np.floor(SCALE * _matrix(vectors, width))
            row = (label, len(x), width, whole.column("id").to_numpy().astype("<i8").tobytes(), whole.column("asks").to_numpy().astype(np.uint8).tobytes(), _pack(x), x.min(0).tolist(), x.max(0).tolist())
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["label", "n", "width", "ids", "asks", "vectors", "low", "high"])

        for batch in batches:
            labels = batch.column("label").to_pylist()
            a = 0
            while a < len(labels):
                b = a
                while b < len(labels) and labels[b] == labels[a] and b - a < BLOCK - (count if labels[a] == label else 0):
                    b += 1
                if count and (labels[a] != label or b == a):
                    yield told()
                    held, count = [], 0
                    label = labels[a]
                    continue
                label = labels[a]
                held.append(batch.slice(a, b - a))
                count += b - a
                a = b
        if count:
            yield told()

    keyed = rows.select("id", F.col("label").cast("string").alias("label"), "vector", "asks").mapInArrow(place, "id long, label string, vector array<double>, asks boolean, place long")
    ranged = cut(keyed).repartitionByRange(task_count(rows.sparkSession), "label", "place", "id").sortWithinPartitions("label", "place", "id")
    ranged.mapInArrow(write, BLOCK_DDL).withColumn("block", F.monotonically_increasing_id()).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


GROUP_DDL = "label string, n int, width int, ids binary, vectors binary"


def anchor_groups(blocks: DataFrame) -> DataFrame:
    """(grp, label, n, width, ids, vectors) of neighbouring anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, n, width, ids, asks, vectors in zip(*(batch.column(c).to_pylist() for c in ("label", "n", "width", "ids", "asks", "vectors")), strict=True):
                some = np.flatnonzero(np.frombuffer(asks, np.uint8))
                ids, x = np.frombuffer(ids, "<i8")[some], _unpack(vectors, n, width)[some]
                rows += [(label, len(ids[a:a + GROUP]), width, ids[a:a + GROUP].tobytes(), _pack(x[a:a + GROUP])) for a in range(0, len(some), GROUP)]
            if rows:
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["label", "n", "width", "ids", "vectors"])

    found = blocks.select("label", "n", "width", "ids", "asks", "vectors").mapInArrow(run, GROUP_DDL)
    return cut(found.withColumn("grp", F.monotonically_increasing_id()))


PAGE_DDL = "blocks binary, labels array<string>, width int, low binary, high binary"


def zone_pages(blocks: DataFrame) -> DataFrame:
    """(page, blocks, labels, width, low, high): zone maps of PAGE blocks, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def told() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            width = max(whole.column("width").to_pylist())
            low, high = (_matrix(whole.column(c).chunk(0), width) for c in ("low", "high"))
            row = (whole.column("block").to_numpy().astype("<i8").tobytes(), whole.column("label").to_pylist(), width, low.tobytes(), high.tobytes())
            kinds = (pa.binary(), pa.list_(pa.string()), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["blocks", "labels", "width", "low", "high"])

        for batch in batches:
            for a in range(0, batch.num_rows, PAGE):
                held.append(batch.slice(a, PAGE))
                count += held[-1].num_rows
                if count >= PAGE:
                    yield told()
                    held, count = [], 0
        if count:
            yield told()

    zones = blocks.select("block", "label", "width", "low", "high").mapInArrow(run, PAGE_DDL)
    return with_ordinal(zones.withColumn("own", F.monotonically_increasing_id()), [], ["own"], "page").drop("own")


# -- search ----------------------------------------------------------------------------

def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, so that a batch of packed blocks isn't copied whole."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _bounds(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores of anchors (rows) with rows of blocks (columns)."""
    width = max(x.shape[1], low.shape[1])
    x, low, high = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, low, high))
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    slack = SLACK * (np.abs(x) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def pick(asked: DataFrame, pages: DataFrame, same: bool, seeds: int | None) -> DataFrame:
    """(grp, block) pairs to be read for groups with open windows (grp, label, n,
    width, vectors, and per window the anchor's place, least and greatest score).

    ``same``: blocks of the group's label, else of the others.  ``seeds``: that many
    per page, those whose scores lie about the windows' upper ends; None: all that
    some window needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, found = [], []
            for r in _rows(batch):
                x = _unpack(r["vectors"], r["n"], r["width"])
                places, least, most = (np.frombuffer(r[c], t) for c, t in (("place", "<i4"), ("least", "<f8"), ("most", "<f8")))
                blocks = np.frombuffer(r["blocks"], "<i8")
                some = np.array([(label == r["label"]) == same for label in r["labels"]])
                low, high = (np.frombuffer(r[c], "<f8").reshape(len(blocks), r["zone_width"])[some] for c in ("low", "high"))
                blocks = blocks[some]
                if not len(blocks) or not len(places):
                    continue
                under, over = _bounds(x, low, high)
                open_ = (over[places] >= least[:, None]) & (under[places] <= most[:, None])
                if seeds is None:
                    chosen = open_.any(0)
                else:
                    middle = (under + over)[places] / 2
                    top = np.minimum(most, over[places].max(1))[:, None]  # an open end counts as the best bound
                    far = np.where(open_.any(0), np.abs(middle - top).mean(0), np.inf)
                    chosen = np.zeros(len(blocks), bool)
                    chosen[np.argsort(far, kind="stable")[:seeds]] = True
                    chosen &= open_.any(0)
                found.append(blocks[chosen])
                groups.append(np.full(len(found[-1]), r["grp"]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(groups)), pa.array(np.concatenate(found))], names=["grp", "block"])

    n = pages.count()
    dealt = asked.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))) if n else asked.withColumn("page", F.lit(0).cast("bigint"))
    told = dealt.join(pages.withColumnRenamed("width", "zone_width"), "page")
    wanted = told.select("grp", "label", "n", "width", "vectors", "place", "least", "most", "blocks", "labels", "zone_width", "low", "high")
    return wanted.mapInArrow(run, "grp long, block long")


FOUND = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("other", pa.int64()), ("score", pa.float64())])
FOUND_DDL = "anchor long, window long, other long, score double"


def look(pairs: DataFrame, asked: DataFrame, blocks: DataFrame, wanted: int) -> DataFrame:
    """(anchor, window, other, score) of the ``wanted`` best rows of every block that
    is read, within each window; the anchor itself isn't among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                x, y = _unpack(r["vectors"], r["n"], r["width"]), _unpack(r["b_vectors"], r["b_n"], r["b_width"])
                own, ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["b_ids"], "<i8")
                places, least, most, window = (np.frombuffer(r[c], t) for c, t in (("place", "<i4"), ("least", "<f8"), ("most", "<f8"), ("window", "<i8")))
                width = min(x.shape[1], y.shape[1])
                scores = (x[:, :width] @ y[:, :width].T)[places]
                inside = (scores >= least[:, None]) & (scores <= most[:, None]) & (own[places][:, None] != ids)
                at, row = np.nonzero(inside)
                score = scores[at, row]
                order = np.lexsort((ids[row], -score, at))
                at, row, score = at[order], row[order], score[order]
                first = np.searchsorted(at, at)
                best = np.arange(len(at)) - first < wanted
                at, row, score = at[best], row[best], score[best]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(own[places[at]]), pa.array(window[at]), pa.array(ids[row]), pa.array(score)], schema=FOUND)

    told = pairs.join(asked, "grp").select("block", "n", "width", "ids", "vectors", "place", "least", "most", "window")
    stored = blocks.select("block", *[F.col(c).alias(f"b_{c}") for c in ("n", "width", "ids", "vectors")])
    return told.join(stored, "block").mapInArrow(run, FOUND_DDL)


def ranked(found: DataFrame, wanted: int) -> DataFrame:
    """The best rows of each (anchor, window), with their rank from 1."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


ASKED_DDL = "grp long, label string, n int, width int, ids binary, vectors binary, place binary, least binary, most binary, window binary"


def ask(groups: DataFrame, windows: DataFrame) -> DataFrame:
    """Groups with the windows (grp, anchor, window, least, most) of their anchors,
    packed; a group without windows falls out."""
    def run(group: pa.Table, told: pa.Table) -> pa.Table:
        if not (group.num_rows and told.num_rows):
            return pa.Table.from_pylist([], kinds)
        row = group.to_pylist()[0]
        place = {a: i for i, a in enumerate(np.frombuffer(row["ids"], "<i8").tolist())}
        row["place"] = np.array([place[a] for a in told.column("anchor").to_pylist()], "<i4").tobytes()
        for name, kind in (("least", "<f8"), ("most", "<f8"), ("window", "<i8")):
            row[name] = told.column(name).to_numpy().astype(kind).tobytes()
        return pa.Table.from_pylist([row], kinds)

    kinds = pa.schema([("grp", pa.int64()), ("label", pa.string()), ("n", pa.int32()), ("width", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "place", "least", "most", "window"))])
    return groups.groupBy("grp").cogroup(windows.groupBy("grp")).applyInArrow(run, ASKED_DDL)


def search(groups: DataFrame, windows: DataFrame, blocks: DataFrame, pages: DataFrame, same: bool, wanted: int) -> DataFrame:
    """The ``wanted`` best rows (anchor, window, other, score, rank) of every window
    (grp, anchor, window, least, most)."""
    asked = cut(ask(groups, windows))
    seen = cut(ranked(look(pick(asked, pages, same, SEEDS), asked, blocks, wanted), wanted))
    last = seen.where(F.col("rank") == wanted).select("anchor", "window", F.col("score").alias("known"))
    closer = windows.join(last, ["anchor", "window"], "left").select("grp", "anchor", "window", F.greatest("least", "known").alias("least"), "most")
    asked = cut(ask(groups, closer))
    return cut(ranked(look(pick(asked, pages, same, None), asked, blocks, wanted), wanted))


def members(groups: DataFrame) -> DataFrame:
    """(grp, anchor) of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, ids in zip(batch.column("grp").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                own = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), grp)), pa.array(own)], names=["grp", "anchor"])

    return groups.select("grp", "ids").mapInArrow(run, "grp long, anchor long")


def mine(rows: DataFrame, id_col: Column, vector: Column, label: Column, asks: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives of the rows for which ``asks`` holds: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of its label; a positive's negatives are
    the best rows of other labels whose score is at least ``low`` and at most ``high``
    per cent of the positive's."""
    spark = rows.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    blocks = write_blocks(cut(take_part(rows, id_col, vector, label, asks)), folder)
    groups, pages = anchor_groups(blocks), cut(zone_pages(blocks))
    own = members(groups)
    no_end = F.lit(float("inf"))
    near = search(groups, own.select("grp", "anchor", F.lit(0).cast("long").alias("window"), (-no_end).alias("least"), no_end.alias("most")), blocks, pages, True, positives)
    near = near.select("anchor", F.col("other").alias("window"), F.col("score").alias("positive"))
    p = F.col("positive")
    exact = F.abs(p) < EXACT
    least = F.when(exact, F.expr(f"(cast(positive as bigint) * {low} + 99) div 100").cast("double")).otherwise(F.ceil(p * low / 100).cast("double"))
    most = F.when(exact, F.expr(f"cast(positive as bigint) * {high} div 100").cast("double")).otherwise(F.floor(p * high / 100).cast("double"))
    opened = own.join(near.where("positive >= 0"), "anchor")  # a negative score has an empty window
    windows = opened.select("grp", "anchor", "window", least.alias("least"), most.alias("most")).where("least <= most")
    told = search(groups, windows, blocks, pages, False, negatives).join(near, ["anchor", "window"])
    return told.select(F.col("anchor").alias("anchor_id"), F.col("window").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
                       F.col("positive").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"))
