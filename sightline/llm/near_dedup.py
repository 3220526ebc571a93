"""Near-duplicate classes of texts: BagMinHash signatures, banding, exact verification, components.

Similarity is the weighted Jaccard similarity of the multisets of five-word shingles (words are
runs of letters and digits in lower case); 0.8 or more makes a link, and classes are the connected
components of the links.

BagMinHash: each distinct shingle with multiplicity w runs independent Poisson processes on the
weight levels (0,1], (1,2], (2,4], (4,8], ..., each with a rate equal to its length; a level that w
cuts through keeps the points below w (its halves, quarters, ... down to unit levels, read off the
bits of a hash). Each point goes to one of REGISTERS registers, which keep the earliest time. Two
texts agree in a register with a probability of exactly their weighted Jaccard similarity. A
process stops at its first point later than every register of its text, so long texts cost about
one point per shingle.

Finding links without emitting all pairs of a group:
1. Texts with equal words are one node, so copies never meet each other again.
2. In every band bucket each node is paired with the bucket's leader and the pairs are verified.
   Pairs whose signatures differ in over FAR registers are left to the next step, unless they are all
   that a bucket holds.
3. Buckets of more than two nodes that still hold several components are searched across components. A bucket goes to one
   task in blocks of BLOCK nodes (a larger one as pairs of blocks); each pair that no earlier bucket
   has and no component connects gets its exact similarity, from products of the block's shingle
   counts. Only links that join components leave the task, so no link between different texts that
   share a bucket is lost and no group's pairs are listed.

BANDS x ROWS registers are banded: a pair at 0.8 shares a bucket with probability 0.99997.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import ALNUM, SPACE_CUT, U64, Words, buffers, lowered, mix, shingles, slabs, spans
from .cluster import bounded_batches, cut, fresh

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 26, 5
REGISTERS = BANDS * ROWS
#: Four bits of the first COMPARED registers are compared: at similarity 0.8, 24 differ on average, with a deviation of 4.4.
COMPARED, FAR = 128, 43
BLOCK = 512
#: Bytes of the texts that a task compares at once.
PAIR_BYTES = 1 << 20
#: Shingles that a block multiplies at once, and repetitions of a shingle up to which it does.
COLUMNS, LEVELS = 2048, 4
#: Bytes of texts that are sketched together.
SLAB = 1 << 19


def _multisets(data: np.ndarray, offsets: np.ndarray, keyed: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Row, fingerprint and multiplicity of each row's distinct shingles; and the words, with keyed ready for their keys."""
    words = spans(data, offsets, ALNUM)
    if keyed:
        words.both()
    hashes, row = shingles(words, SHINGLE)
    order = np.argsort(hashes ^ mix(row.astype(U64), 5))  # equal (row, hash) pairs stand together
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    count = np.diff(np.flatnonzero(np.append(new, True)))
    return row[new], hashes[new], count, words


def bagminhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (n, registers) of n multisets given as (row, element, integer weight); infinite for empty ones."""
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1 if len(weight) else np.zeros(0, np.int64)
    item = np.repeat(np.arange(len(row)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1))
    rate = np.where(level == 0, 1.0, low)
    doc, seed, most = row[item], mix(element[item] ^ mix(level.astype(U64), 21), 22), weight[item].astype(float)
    partial = most < low + rate
    best = np.full(n * registers, np.inf)
    time, tick = np.zeros(len(item)), np.zeros(len(item), U64)
    latest = np.full(n, np.inf)
    while len(doc):
        burst = int(np.clip(200_000 // len(doc), 1, 64))
        ticks = tick[:, None] + np.arange(burst, dtype=U64)
        a = mix(seed[:, None] ^ mix(ticks, 23), 24)
        at = (a >> U64(11)).astype(float)
        at += 0.5
        at *= 2.0**-53
        np.log(at, out=at)
        at /= -rate[:, None]
        at[:, 0] += time
        np.cumsum(at, axis=1, out=at)  # added one by one, so that equal multisets get equal times whatever the burst
        take = at <= latest[doc][:, None]
        if partial.any():
            cut = np.flatnonzero(partial)
            share = (mix(a[cut], 25) & U64(0xFFFFFFFF)).astype(float) / 2.0**32
            take[cut] &= low[cut, None] + np.floor(share * rate[cut, None]) < most[cut, None]
        # the eleven bits that the time leaves choose the register
        slot = ((a & U64(2047)) * U64(registers) >> U64(11)).astype(np.int64)
        slot += (doc * registers)[:, None]
        np.minimum.at(best, slot[take], at[take])
        touched = np.zeros(n, bool)
        touched[doc] = True
        latest[touched] = best.reshape(n, registers)[touched].max(axis=1)
        time, tick = at[:, -1], tick + U64(burst)
        stay = time < latest[doc]
        doc, seed, most, partial, low, rate, time, tick = (x[stay] for x in (doc, seed, most, partial, low, rate, time, tick))
    return best.reshape(n, registers)


def _banded(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys (n, BANDS), and four bits of each register, packed."""
    bits = mix(signature.view(U64).reshape(signature.shape), 31)
    with np.errstate(over="ignore"):
        keys = np.zeros((len(bits), BANDS), U64)
        for r in range(ROWS):
            keys = mix(keys + bits[:, r * BANDS : (r + 1) * BANDS], 32 + r)
        keys = mix(keys + np.arange(BANDS, dtype=U64), 40)
    four = (bits[:, :COMPARED] & U64(15)).astype(np.uint8)
    return keys, four[:, ::2] << 4 | four[:, 1::2]


def _key(key: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(key), [None, pa.py_buffer(np.ascontiguousarray(key).tobytes())]).cast(pa.binary())


def _sketch(docs: DataFrame, id_col: str, text_col: str, more: tuple[str, ...] = (), counted: bool = False) -> DataFrame:
    """id, node (16 bytes; null without words), bands and signature (packed) of every row, its columns more (as _0, _1, ...), and with counted its n_words cut at white space."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(lowered(batch.column("_text")))
            if counted:
                raw, at_raw = buffers(batch.column("_text"))
                n_words = np.concatenate([*(np.diff(spans(raw[at_raw[i] : at_raw[j]], at_raw[i : j + 1] - at_raw[i], SPACE_CUT).first) for i, j in slabs(at_raw)), np.zeros(0, np.int64)])
            for i, j in slabs(offsets, SLAB):
                row, element, weight, words = _multisets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], True)
                key = words.keys()
                filled = np.bincount(row, minlength=j - i) > 0
                # equal texts of a slab are sketched once
                _, first, same = np.unique(key, axis=0, return_index=True, return_inverse=True)
                chosen = np.zeros(j - i, bool)
                chosen[first] = True
                at = np.cumsum(chosen) - 1
                mine = chosen[row]
                signature = bagminhash(at[row[mine]], element[mine], weight[mine], len(first))
                bands, bits = _banded(signature)
                back = at[first][same.ravel()]
                packed = bands.astype("<u8").tobytes()
                size = 8 * BANDS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(i, j - i),
                        pa.array(np.where(filled, _key(key).to_numpy(zero_copy_only=False), None), pa.binary()),
                        pa.array([packed[size * k : size * (k + 1)] for k in back], pa.binary()),
                        pa.array([bits[k].tobytes() for k in back], pa.binary()),
                        *(batch.column(name).slice(i, j - i) for name in kept),
                        *([pa.array(n_words[i:j])] if counted else []),
                    ],
                    ["_id", "node", "bands", "signature", *kept, *(["n_words"] if counted else [])],
                )

    kept = [f"_{k}" for k in range(len(more))]
    types = [docs.schema[c].dataType.simpleString() for c in (id_col, *more)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *(F.col(c).alias(k) for c, k in zip(more, kept, strict=True)))
    schema = f"_id {types[0]}, node binary, bands binary, signature binary" + "".join(f", {k} {x}" for k, x in zip(kept, types[1:], strict=True))
    return texts.mapInArrow(run, schema + (", n_words long" if counted else ""))


def text_keys(words: Words) -> np.ndarray:
    """The key of each row's words (node); None without words."""
    return np.where(np.diff(words.first) > 0, _key(words.keys()).to_numpy(zero_copy_only=False), None)


def with_key(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """docs with the key of each text's words in one more column; null without words."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(lowered(batch.column(text_col)))
            keys = []
            for i, j in slabs(offsets):
                words = spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)
                keys += text_keys(words).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, name])

    from pyspark.sql.types import BinaryType, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, BinaryType()))


def _similarities(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each pair."""
    out, total = [np.zeros(0)], buffers(a)[1] + buffers(b)[1]
    for i, j in slabs(total, PAIR_BYTES):
        out.append(_alike([buffers(lowered(x.slice(i, j - i))) for x in (a, b)], j - i))
    return np.concatenate(out)


def _alike(sides: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    row, value, count = (np.concatenate(x) for x in zip(*(_multisets(*side)[:3] for side in sides), strict=True))
    order = np.argsort(value ^ mix(row.astype(U64), 5))
    row, value, count = row[order], value[order], count[order]
    twin = np.flatnonzero((row[1:] == row[:-1]) & (value[1:] == value[:-1]))
    both = np.bincount(row[twin], weights=np.minimum(count[twin], count[twin + 1]), minlength=n)
    total = np.bincount(row, weights=count, minlength=n)
    return np.divide(both, total - both, out=np.zeros(n), where=total > both)


def _verified(pairs: DataFrame, content: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    sided = pairs.join(content.select(F.col("node").alias("a"), F.col("_text").alias("text_a")), "a").join(content.select(F.col("node").alias("b"), F.col("_text").alias("text_b")), "b")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(_similarities(batch.column("text_a"), batch.column("text_b")) >= least))
            pa.default_memory_pool().release_unused()

    return sided.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is its smallest node.

    Labels spread along edges and then jump to their label's label, so a chain of n links takes
    about log n rounds; each round ends in a checkpoint. Only counts reach the driver.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        roots = labels.select(F.col("node").alias("label"), F.col("component").alias("root"))
        after = cut(spread.join(roots, "label", "left").select("node", "old", F.least("label", "root").alias("component")))
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")


def _near(a: str, b: str) -> Column:
    """Whether at most FAR of the compared registers differ in their four bits."""

    def differing(n: Column, x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return n + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111)))

    return F.aggregate(F.zip_with(f"{a}.signature", f"{b}.signature", lambda x, y: x.bitwiseXOR(y)), F.lit(0), differing) <= FAR


def _roots(parent: np.ndarray) -> np.ndarray:
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


def _common(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each two texts the size of their shingle multisets' intersection; and each multiset's size."""
    n, parts = len(texts), []
    _, offsets = buffers(texts)
    for i, j in slabs(offsets, PAIR_BYTES):
        row, value, count, _ = _multisets(*buffers(lowered(texts.slice(i, j - i))))
        parts.append((row + i, value, count))
    row, value, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    size = np.bincount(row, weights=count, minlength=n)
    order = np.argsort(value, kind="stable")
    row, value, count = row[order], value[order], count[order]
    new = np.diff(value, prepend=value[:1] ^ U64(1)) != 0
    column = np.cumsum(new) - 1
    several = (np.bincount(column) > 1)[column]
    row, column, count = row[several], column[several], count[several]
    both, level = np.zeros((n, n), np.float32), 1
    while len(row):  # the smaller of two counts is the number of levels that both reach
        edges = np.flatnonzero(np.diff(column, prepend=-1))
        if level > LEVELS:  # what is left are few shingles that a text repeats often
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(row)], strict=True):
                r, c = row[a:b], count[a:b] - LEVELS
                both[np.ix_(r, r)] += np.minimum(c[:, None], c[None, :])
            break
        for k in range(0, len(edges), COLUMNS):
            a, b = edges[k], edges[k + COLUMNS] if k + COLUMNS < len(edges) else len(row)
            block = np.zeros((n, min(COLUMNS, len(edges) - k)), np.float32)
            block[row[a:b], np.searchsorted(edges[k : k + COLUMNS], np.arange(a, b), "right") - 1] = 1
            both += block @ block.T
        stay = count > level
        row, column, count = row[stay], column[stay], count[stay]
        many = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
        row, column, count = row[many], column[many], count[many]
        level += 1
    return both, size


def _joining_links(table: pa.Table, least: float) -> pa.Table:
    """Links between the two blocks of a tile that join different components."""
    n = table.num_rows
    node = table.column("node").to_pylist()
    _, parent = np.unique(table.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
    _, first = np.unique(parent, return_index=True)
    parent = first[parent]
    half = np.array(table.column("half").to_pylist())
    left, right = (np.arange(n), np.arange(n)) if (half == half[0]).all() and table.column("i")[0] == table.column("j")[0] else (np.flatnonzero(half == 0), np.flatnonzero(half == 1))
    bands = np.frombuffer(b"".join(table.column("bands").to_pylist()), "<i8").reshape(n, BANDS)
    here = int(np.flatnonzero((bands == table.column("bucket")[0].as_py()).all(axis=0))[0])
    open_, pairs = np.zeros(n, bool), []
    for x in left:
        y = right[right > x] if left is right or len(left) == n else right
        y = y[(parent[y] != parent[x]) & ~(bands[y, :here] == bands[x, :here]).any(axis=1)]
        pairs.append(np.column_stack([np.full(len(y), x), y]))
        open_[y] = True
        open_[x] |= len(y) > 0
    pairs, links = np.concatenate([*pairs, np.zeros((0, 2), np.int64)]), []
    if len(pairs):
        both, size = _common(table.column("_text").combine_chunks().filter(pa.array(open_)))
        at = np.cumsum(open_) - 1
        x, y = at[pairs[:, 0]], at[pairs[:, 1]]
        common = both[x, y].astype(float)
        pairs = pairs[common >= least * (size[x] + size[y] - common)]
    while len(pairs):
        for x, y in pairs[:128].tolist():
            if parent[x] != parent[y]:
                links.append((node[x], node[y]))
                parent[max(parent[x], parent[y])] = min(parent[x], parent[y])
                parent = _roots(parent)
        pairs = pairs[parent[pairs[:, 0]] != parent[pairs[:, 1]]]
    pa.default_memory_pool().release_unused()
    return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})


def _rows_and_labels(docs: DataFrame, id_col: str, text_col: str, least: float, more: tuple[str, ...] = (), counted: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows' (_id, node) with what _sketch adds for more and counted, and (node, component) for the nodes with a link."""
    bounded_batches(docs.sparkSession)
    sketch = cut(_sketch(docs, id_col, text_col, more, counted))
    nodes = sketch.where(F.col("node").isNotNull()).groupBy("node").agg(F.any_value("bands").alias("bands"))

    def split(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), "<i8")
            at = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("node").take(at)], ["bucket", "node"])

    def spread(batches):
        for batch in batches:
            words = pa.array(np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<i8"))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * (COMPARED // 16))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("bands"), pa.ListArray.from_arrays(offsets, words)], ["node", "bands", "signature"])

    banded = nodes.mapInArrow(split, "bucket long, node binary")
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    buckets = cut(banded.join(shared, "bucket", "left_semi"))
    members = buckets.select("node").distinct()
    signed = sketch.join(members, "node", "left_semi").groupBy("node").agg(F.any_value("bands").alias("bands"), F.any_value("signature").alias("signature"))
    signed = cut(signed.mapInArrow(spread, "node binary, bands binary, signature array<long>"))
    content = cut(with_key(docs.select(F.col(text_col).cast("string").alias("_text")), "_text", "node").join(members, "node", "left_semi").groupBy("node").agg(F.min("_text").alias("_text")))

    lead = buckets.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("lead"))).alias("y"), F.count(F.lit(1)).alias("n"))
    stars = buckets.join(lead.select("bucket", "y.lead", "n"), "bucket").where("node != lead").groupBy(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).agg(F.min("n").alias("n"))
    stars = stars.join(signed.alias("x"), F.col("a") == F.col("x.node")).join(signed.alias("y"), F.col("b") == F.col("y.node")).where((F.col("n") == 2) | _near("x", "y")).select("a", "b")
    labels = components(_verified(stars, content, least))

    now = buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = now.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n")).where("x != y and n > 2").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("k"))
    active = now.join(mixed, "bucket").withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), "k").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    tiles = active.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("half"), "node", "component")
    told = tiles.join(signed.select("node", "bands"), "node").join(content, "node")
    more = cut(told.groupBy("bucket", "i", "j").applyInArrow(lambda table: _joining_links(table, least), "a binary, b binary"))
    if not more.isEmpty():
        # the components so far are stars around their smallest nodes
        labels = components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a != b")))
    return sketch.drop("bands", "signature"), labels


def counted_classes(docs: DataFrame, id_col: str, text_col: str, more: str, least: float = SIMILARITY) -> DataFrame:
    """_id, the column more as _0, n_words (cut at white space) and cluster of every row: a key that exactly the texts of its near-duplicate class have, null without words."""
    rows, labels = _rows_and_labels(docs, id_col, text_col, least, (more,), True)
    return rows.join(labels, "node", "left").select("_id", "_0", "n_words", F.coalesce("component", "node").alias("cluster"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of docs: id and class_id, the smallest id of its near-duplicate class.

    Texts with equal words are always of one class; a text of one to four words has one shingle of
    all its words. Null, empty and wordless texts are of no class but their own. Null ids count as
    the largest; a class of null ids only has a null class_id. Repeated rows are copies of each
    other; other columns are ignored.
    """
    rows, labels = _rows_and_labels(docs, id_col, text_col, least)
    named = rows.join(labels, "node", "left").select("_id", F.coalesce("component", "node").alias("component"))
    smallest = named.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("_id").alias("least_id"))
    out = named.join(smallest, "component", "left")
    return out.select(F.col("_id").alias(id_col), F.when(F.col("component").isNull(), F.col("_id")).otherwise(F.col("least_id")).alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each near-duplicate class, that with the smallest id, with all columns of docs; wordless rows all stay."""
    rows, labels = _rows_and_labels(docs, id_col, text_col, least)
    named = rows.where(F.col("node").isNotNull()).join(labels, "node", "left")
    best = named.groupBy(F.coalesce("component", "node").alias("c")).agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "node")).alias("m"))
    node, kept_id, kept_node, nth = (fresh(n, docs.columns) for n in ("_node", "_kept_id", "_kept_node", "_nth"))
    kept = best.select(F.col("m._id").alias(kept_id), F.col("m.node").alias(kept_node))
    keyed = with_key(docs, text_col, node)
    chosen = keyed.join(kept, (F.col(node) == F.col(kept_node)) & F.col(id_col).eqNullSafe(F.col(kept_id)))
    first = chosen.withColumn(nth, F.row_number().over(Window.partitionBy(node).orderBy(text_col)))
    return first.where(F.col(nth) == 1).select(*docs.columns).unionByName(keyed.where(F.col(node).isNull()).select(*docs.columns))
