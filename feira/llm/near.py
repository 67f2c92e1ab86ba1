"""Near duplicates by ProbMinHash: weighted shingles, banding, exact verification, classes.

A text is the multiset of its five-word shingles. For each shingle the arrivals of a Poisson process,
whose rate is the shingle's count, fall into random slots of the signature; a slot keeps the shingle
that arrives first. A text stops drawing once the next arrival comes after all its slots are taken by
earlier ones. Two texts agree in a slot with the probability Jaccard similarity of their multisets,
which for sets is the usual Jaccard similarity.

With 32 bands of 5 slots a pair of similarity 0.8 shares no band with probability 3e-6. Texts of equal
words are one node from the start. In every bucket each node is paired with one hub, another in each band;
pairs are verified on the whole texts and joined to classes. Where a bucket still holds several classes, its
nodes get a code, one bit of each slot of a much longer signature, and meet some more hubs; in what then is left,
all nodes of different classes are compared by their codes, each pair in the first band it shares, and those
that may be similar by that are verified. So no link is lost to the choice of the hubs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from feira.llm.hashing import BASES, Chunk, chunks, mix, rolling
from feira.llm.tables import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_SLOTS = 32, 5
SLOTS = BANDS * BAND_SLOTS
# Codes are this many bits long. Two texts of similarity s agree in a bit with probability (1 + s) / 2.
CODE_BITS = 2048
# Pairs of one bucket, from different classes, are not verified if their bits agree less often than those of
# texts that are just similar enough, by so many standard deviations: that happens with probability 6e-6.
DEVIATIONS = 4.5
# Texts whose codes are worked out at a time.
TOGETHER = 256
# Hubs that each node of a bucket with several classes meets besides the first.
MORE_HUBS = 3
STEP = 0x9E3779B97F4A7C15


# --- signatures


def shingles(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the chunk, shingle, count), sorted by row; a shorter text is one shingle."""
    x, owners = chunk.hashes(), chunk.owners()
    starts = np.flatnonzero(owners[: max(0, len(owners) - size + 1)] == owners[size - 1 :])
    values, rows = mix(rolling(x, size)[starts]), owners[starts]
    begins = np.cumsum(chunk.counts) - chunk.counts
    short = np.flatnonzero((chunk.counts > 0) & (chunk.counts < size))
    if len(short):
        whole = [mix(rolling(x[begins[i] : begins[i] + chunk.counts[i]], int(chunk.counts[i])) + np.uint64(STEP))[0] for i in short]
        values, rows = np.r_[values, np.array(whole, np.uint64)], np.r_[rows, short]
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    first = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])][: len(values)])
    return rows[first], values[first], np.diff(np.r_[first, len(values)])


def signatures(
    rows: np.ndarray, values: np.ndarray, weights: np.ndarray, n_rows: int, slots: int = SLOTS
) -> np.ndarray:
    """The ProbMinHash signature of each row: the shingle that comes first in each slot."""
    times = np.full(n_rows * slots, np.inf)
    chosen = np.zeros(n_rows * slots, np.uint64)
    sizes = np.bincount(rows, minlength=n_rows)
    alone = np.flatnonzero(sizes == 1)
    if len(alone):
        # A single shingle comes first everywhere.
        single = sizes[rows] == 1
        chosen.reshape(n_rows, slots)[rows[single]] = values[single][:, None]
    active = np.flatnonzero(sizes[rows] > 1)
    at = np.zeros(len(rows))
    step = 0
    while len(active):
        step = (step + STEP) % (1 << 64)
        drawn = mix(values[active] + np.uint64(step))
        gap = -np.log(((drawn >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53))
        at[active] += gap / weights[active]
        now, owner = at[active], rows[active]
        slot = owner * slots + (mix(drawn) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(times, slot, now)
        won = times[slot] == now
        chosen[slot[won]] = values[active][won]
        open_rows, place = np.unique(owner, return_inverse=True)
        last = times.reshape(n_rows, slots)[open_rows].max(axis=1)
        active = active[now < last[place]]
    return chosen.reshape(n_rows, slots)


def _text_hashes(chunk: Chunk) -> np.ndarray:
    """Two 64-bit hashes of the word sequence of each row."""
    x = chunk.hashes()
    ends = np.cumsum(chunk.counts)
    begins = ends - chunk.counts
    own = np.arange(len(x)) - np.repeat(begins, chunk.counts)
    both = []
    for base in BASES:
        # Each word is mixed with its place, so that equal sums need equal words at equal places.
        placed = mix(x * np.uint64(base) + mix(own.astype(np.uint64) + np.uint64(base)))
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)]
        both.append(mix(sums[ends] - sums[begins] + chunk.counts.astype(np.uint64)))
    return np.array(both)


def _lists(values: np.ndarray) -> pa.Array:
    """One list per row."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, d1, d2, bands) per row with words."""
    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = StructType(
        [
            StructField("k", picked.schema["k"].dataType),
            StructField("d1", LongType()),
            StructField("d2", LongType()),
            StructField("bands", ArrayType(LongType(), False)),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                n_rows = len(chunk.counts)
                kept = np.flatnonzero(chunk.counts)
                if not len(kept):
                    continue
                slots = signatures(*shingles(chunk), n_rows)[kept]
                bands = np.zeros((len(kept), BANDS), np.uint64)
                for i in range(BAND_SLOTS):
                    bands = mix(bands + slots[:, i::BAND_SLOTS] * np.uint64(STEP))
                hashes = _text_hashes(chunk).view(np.int64)[:, kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(kept + chunk.begin)),
                        pa.array(hashes[0]),
                        pa.array(hashes[1]),
                        _lists(bands.view(np.int64)),
                    ],
                    schema.fieldNames(),
                )

    return picked.filter("k IS NOT NULL").mapInArrow(run, schema)


def codes(texts: DataFrame) -> DataFrame:
    """(node, code) of (k, t): CODE_BITS bits as longs, one of each slot of a signature of that length."""
    schema = StructType(
        [StructField("node", texts.schema["k"].dataType), StructField("code", ArrayType(LongType(), False))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                rows, values, counts = shingles(chunk)
                for begin in range(0, len(chunk.counts), TOGETHER):
                    size = min(TOGETHER, len(chunk.counts) - begin)
                    low, high = np.searchsorted(rows, (begin, begin + size))
                    own = signatures(rows[low:high] - begin, values[low:high], counts[low:high], size, CODE_BITS)
                    bits = np.packbits((own & np.uint64(1)).astype(np.uint8), axis=1)
                    keys = batch.column(0).slice(chunk.begin + begin, size)
                    yield pa.RecordBatch.from_arrays([keys, _lists(bits.view(np.int64))], schema.fieldNames())

    return texts.select("k", "t").mapInArrow(run, schema)


def agreeing_bits(similarity: float) -> int:
    """How many bits of a code have to agree."""
    share = (1 + similarity) / 2
    return int(CODE_BITS * share - DEVIATIONS * (CODE_BITS * share * (1 - share)) ** 0.5)


# --- verification


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two multisets as (sorted values, counts).

    The sum over common values i of 1 / sum_j max(a_j / a_i, b_j / b_i). In order of the ratio
    a_j / b_j, the maximum is the first part from i's ratio on and the second before it.
    """
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    begin = np.searchsorted(ratio, ratio, side="left")
    from_here = np.r_[np.cumsum(x[::-1])[::-1], 0][begin]
    before = np.r_[0, np.cumsum(y)][begin]
    both = (x > 0) & (y > 0)
    return float((1 / (from_here[both] / x[both] + before[both] / y[both])).sum())


def _multiset(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    found = [shingles(chunk) for chunk in chunks(pa.array([text], pa.string()))]
    return found[0][1], found[0][2]


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are that similar."""
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    ends = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct()
    # Stored, so that each text is looked for once and both joins below can split a hot node. The hints
    # keep small inputs on the plan that large ones need.
    known = stored(texts.join(ends.hint("shuffle_hash"), "k", "left_semi"), "paired-texts")
    first = pairs.hint("merge").join(known.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a")
    both = first.hint("merge").join(known.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")
    schema = StructType([StructField(name, pairs.schema[name].dataType) for name in ("a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
            good = []
            for ours, theirs in zip(batch.column(2), batch.column(3)):
                theirs = theirs.as_py()
                if theirs not in seen:
                    # Neighbouring rows share the text they are compared with.
                    seen = {theirs: _multiset(theirs)}
                good.append(probability_jaccard(_multiset(ours.as_py()), seen[theirs]) >= similarity)
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(good, pa.bool_())) for column in batch.columns[:2]], ["a", "b"]
            )

    return both.select("a", "b", "ta", "tb").mapInArrow(run, schema).distinct()


# --- classes


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected edges (a, b): the smallest node it is linked to.

    Every round gives each node the smallest node around it, follows these twice, and draws the nodes
    that got one label together, so that the edges between them go and the others become fewer. Rounds are written
    tables; only whether edges are left reaches the driver.
    """
    left = stored(edges.select(*_ordered("a", "b")).filter("a <> b").distinct(), "links")
    labels = None
    while True:
        both = left.union(left.select("b", "a"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        step = stored(step.select("node", F.least("node", "near").alias("label")), "labels")
        for _ in range(2):
            further = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            step = stored(step.join(further, "label").select("node", F.col("next").alias("label")), "labels")
        labels = step if labels is None else _followed(labels, step)
        left = stored(_between(left, step), "links")
        if not left.limit(1).count():
            return labels


def _followed(labels: DataFrame, step: DataFrame) -> DataFrame:
    """Labels of labels, where `step` has one."""
    on = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return stored(labels.join(on, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")


def _between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The edges (a, b) as edges of labels, without those inside one label; a node without label is its own."""
    for end in ("a", "b"):
        on = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        edges = edges.join(on, end, "left").withColumn(end, F.coalesce(f"{end}_label", end)).drop(f"{end}_label")
    return edges.select(*_ordered("a", "b")).filter("a <> b").distinct()


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` after further links: only classes that these lead to are looked at again."""
    step = components(_between(links, labels))
    new = step.select("node", F.col("node").alias("label")).join(labels, "node", "left_anti")
    return _followed(labels.union(new), step)


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_classes(
    docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, class_id, n_copies), one row per row of `docs`: class_id is the smallest key of all texts that
    are linked by similarities of at least `similarity`, n_copies the number of rows with the same words.

    A NULL or empty text is like no other and a class of its own. A row with a NULL key is in no class
    (NULL) and links no others. Rows with one key are one document, so their texts share a class. Texts of fewer
    words than a shingle are similar if their words are equal. Other columns do not matter. A table
    without rows gives none.
    """
    found = stored(sketches(docs, key, text), "sketches")
    # Copies combine before the shuffle.
    nodes = stored(
        found.groupBy("d1", "d2").agg(
            F.min("k").alias("node"),
            F.count("*").alias("n_copies"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    entries = stored(nodes.select("node", F.posexplode("bands").alias("band", "hash")), "band-entries")
    bucket = ["band", "hash"]
    # The hub is another node in each band, so that each node meets many different ones.
    drawn = F.min(F.struct(F.xxhash64("node", "band").alias("luck"), "node"))
    hubs = entries.groupBy(*bucket).agg(drawn.alias("first"), F.count("*").alias("n")).filter("n > 1")
    hubs = stored(hubs.select(*bucket, F.col("first.node").alias("hub")), "hubs")
    shared = stored(entries.join(hubs, bucket), "shared-buckets")
    pairs = shared.filter("node <> hub").select(*_ordered("node", "hub")).distinct()
    pairs = stored(pairs, "hub-pairs")
    links = stored(verified(pairs, docs, key, text, similarity), "hub-links")
    labels = components(links)

    def labelled(frame: DataFrame, known: DataFrame) -> DataFrame:
        return frame.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def in_mixed_buckets() -> DataFrame:
        """The nodes of every bucket that holds several classes."""
        members = stored(labelled(shared.select("node", *bucket), labels), "bucket-classes")
        mixed = members.groupBy(*bucket).agg(F.min("label").alias("low"), F.max("label").alias("high"))
        mixed = mixed.filter("low < high").select(*bucket)
        return stored(members.join(mixed, bucket), "mixed-buckets")

    def join_classes(alike: DataFrame, tried: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Labels and tried pairs after verifying those pairs of `alike` that are new."""
        new = alike.select(*_ordered("node_x", "node_y")).distinct()
        new = stored(new.join(tried, ["a", "b"], "left_anti"), "more-pairs")
        if not new.limit(1).count():
            return labels, tried
        return joined(labels, stored(verified(new, docs, key, text, similarity), "more-links")), tried.union(new)

    # Written out, so that Spark compiles it: it is worked out for every pair that meets.
    parts = [F.bit_count(F.col("code_x")[i].bitwiseXOR(F.col("code_y")[i])) for i in range(CODE_BITS // 64)]
    differing = reduce(Column.__add__, parts)
    agreeing = differing <= CODE_BITS - agreeing_bits(similarity)
    kept = ("node", "label", "code")
    apart = in_mixed_buckets()
    if apart.limit(1).count():
        texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
        mixed_nodes = apart.select(F.col("node").alias("k")).distinct()
        known = stored(codes(texts.join(mixed_nodes, "k", "left_semi")).distinct(), "codes")
        # More hubs, for nodes that are like few others of a large group.
        drawn = [F.min(F.struct(F.xxhash64(F.lit(i), "node", "band").alias("luck"), "node", "label")) for i in range(MORE_HUBS)]
        hubs = apart.groupBy(*bucket).agg(F.array(*drawn).alias("hubs")).select(*bucket, F.explode("hubs").alias("hub"))
        hubs = hubs.select(*bucket, F.col("hub.node").alias("node"), F.col("hub.label").alias("label")).join(known, "node")
        hubs = stored(hubs.select(*bucket, *[F.col(c).alias(f"{c}_y") for c in kept]), "more-hubs")
        left = apart.join(known, "node").select(*bucket, *[F.col(c).alias(f"{c}_x") for c in kept])
        met = left.join(hubs, [left[c] == hubs[c] for c in bucket] + [F.col("label_x") != F.col("label_y"), agreeing])
        labels, pairs = join_classes(met, pairs)
        apart = in_mixed_buckets()
    if apart.limit(1).count():
        coded = known.join(nodes.select("node", "bands"), "node")
        coded = stored(apart.join(coded, "node"), "coded-buckets")
        left = coded.select(*bucket, *[F.col(c).alias(f"{c}_x") for c in (*kept, "bands")])
        right = coded.select(*bucket, *[F.col(c).alias(f"{c}_y") for c in (*kept, "bands")])
        first_band = F.array_position(F.zip_with("bands_x", "bands_y", lambda x, y: x == y), True) - 1
        alike = left.join(
            right,
            [left[c] == right[c] for c in bucket]
            + [F.col("label_x") < F.col("label_y"), agreeing, first_band == left["band"]],
        )
        labels, pairs = join_classes(alike, pairs)
    classes = stored(labelled(nodes.select("node", "d1", "d2", "n_copies"), labels), "classes")
    member = found.select("k", "d1", "d2").join(classes, ["d1", "d2"])
    member = member.select(F.col("k").alias("doc_id"), F.col("label").alias("class_id"), "n_copies")
    # Rows without words or key have no sketch.
    texts = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    worded = F.coalesce(F.col("t").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = texts.filter(F.col("doc_id").isNull() | ~worded)
    return member.unionByName(
        others.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    )


def without_near_copies(
    docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with one document of each class: the one with the smallest key, once if it is repeated.

    Rows with a NULL key all stay.
    """
    classes = near_classes(docs, similarity, key, text)
    gone = classes.filter("doc_id > class_id").select("doc_id").distinct()
    held = docs.select(F.col(f"`{key}`").alias("k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = held.join(gone, held["k"] == gone["doc_id"], "left_anti")
    own = F.when(F.col("k").isNull(), F.monotonically_increasing_id())
    single = left.withColumn("own", own).groupBy("k", "own").agg(F.min_by("row", F.coalesce(F.col("row").getField(text), F.lit(""))).alias("row"))
    return single.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
