"""N-gram Jaccard join: every link between texts whose shingle sets reach the similarity.

Equal sets form a class first; classes are compared, never their copies. A size-aware
heavy-light join finds the links between classes:

* small sets are enumerated: a set of n shingles that reaches similarity s with another one
  keeps at least ceil(s n) shingles in common, so both hold an equal subset that is the set
  with at most n - ceil(s n) shingles taken away. Equal subset keys meet, and the subset's
  size with the two sizes decides the link;
* large sets scan inverted lists, each over its first n - ceil(s n) + 1 shingles in an order
  that puts the corpus's heavy shingles last, which is enough to meet every partner. The
  candidates of neighbouring list members are verified first; what they connect need not be
  compared again; lists of up to three members are done with that. A second scan takes the pairs
  that would connect components, the most similar first, and notes the lists of which it left
  pairs out; a last one takes all pairs of those lists that are still between components.
  Candidates first pass a bound on small parity bitmaps of their sets, inside the lists already:
  two bitmaps differ in no more bits than the sets have elements apart, so no link is lost.

The boundary between small and large is the size with the lowest estimated cost. All
candidates are verified on whole sets. Heavy shingles only change the order, never a result.

Defined results: null, empty and blank texts have 0 shingles and are linked with nothing (the
component is their own doc_id); a null doc_id takes part and is ignored in the smallest id;
repeated rows come back once each; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from auditlens.llm.components import components
from auditlens.llm.packed import BLOCK_DDL, parts_of, row_blocks, scatter, stored, swept, thrifty, thrifty_group, tuned, unpack
from auditlens.llm.text import column_bytes, mix, shingle_hashes, slices, word_hashes

SHINGLE = 5
PERCENT = 80
#: Heavy shingles that order the lists: at most so many, each in so many texts at least.
HEAVY_KEYS = 1 << 20
HEAVY_LEAST = 16
LOCAL_LEAST = 3
COUNTED = 1_000_000
BOUNDARIES = (4, 9, 14)
#: A list's member is compared with so many next ones at once.
NEIGHBOURS = 2


def kept_least(n, percent: int):
    """ceil(percent n / 100)."""
    return -(-percent * n // 100)


def shingle_sets(column: pa.Array, k: int):
    """Sorted distinct shingle hashes of each text."""
    data, offsets = column_bytes(column)
    for lo, hi in slices(offsets):
        hashes, _, _, rows = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        for i in range(hi - lo):
            yield np.unique(shingle_hashes(hashes[rows[i] : rows[i + 1]], k))


def class_key(s: np.ndarray) -> int:
    """Key of a set: equal sets have equal keys."""
    return int(mix(np.array([mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64))[0].view(np.int64)) if len(s) else 0


def parity_bits(s: np.ndarray) -> bytes:
    """One bit for each of at least len(s) cells: whether it holds an odd number of elements."""
    cells = 1 << max(6, int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((mix(s) % np.uint64(cells)).astype(np.int64), minlength=cells) & 1 == 1, bitorder="little").tobytes()


def bits_allow(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    """False only if sets of n and m elements with these bitmaps miss the similarity."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    apart = int(np.bitwise_count(a ^ b).sum())
    # apart = n + m - 2 both, and 100 both >= percent (n + m - both) for a link
    return (100 + percent) * (n + m - apart) >= 2 * percent * (n + m)


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """One scan: rows (0, doc_id, class, n, bitmap) for texts, and (1, null, shingle, texts)
    for shingles that several of the texts counted together hold. Counts leave after every
    ``COUNTED`` shingles, so a task's memory does not grow with its text; a shingle that is heavy
    in the corpus is among several of them."""

    def scan(batches):
        waiting, size, seen = [], 0, set()

        def shared():
            key, n = np.unique(np.concatenate(waiting), return_counts=True)
            often = n >= LOCAL_LEAST
            none = [None] * int(often.sum())
            return _rows(1, pa.nulls(len(none), pa.int64()), key[often].view(np.int64), n[often], none)

        for batch in batches:
            keys, ns, bits = [], [], []
            for s in shingle_sets(batch.column(1), k):
                keys.append(key := class_key(s))
                ns.append(len(s))
                bits.append(parity_bits(s) if len(s) else None)
                if key not in seen:
                    seen.add(key)
                    waiting.append(s)
                    size += len(s)
                    if size > COUNTED:
                        yield shared()
                        waiting, size, seen = [], 0, set()
            yield _rows(0, batch.column(0), keys, ns, bits)
        if waiting:
            yield shared()

    def _rows(kind, ids, keys, ns, bits):
        columns = [pa.array(np.full(len(ns), kind, np.int8)), ids, pa.array(keys, pa.int64()), pa.array(ns, pa.int64()), pa.array(bits, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["kind", "doc_id", "key", "n", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(scan), "kind byte, doc_id long, key long, n long, bits binary")


def _heavy(profile: DataFrame) -> np.ndarray:
    """Sorted heavy shingles, at most HEAVY_KEYS: the cut is the lowest count that fits."""
    counts = profile.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY_LEAST)
    counts = stored(counts, "heavy")
    # counts by power of sqrt(2): some hundred rows at most
    level = F.floor(2 * F.log2("n"))
    cut, total = None, 0
    for at, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if (total := total + n) > HEAVY_KEYS:
            break
        cut = at
    if cut is None:
        return np.zeros(0, np.uint64)
    got = counts.filter(level >= cut).select("key").toPandas()["key"].to_numpy(np.int64)
    return np.sort(got.view(np.uint64))


def _enumerations(n: int, percent: int) -> int:
    return sum(comb(n, j) for j in range(n - kept_least(n, percent) + 1))


def _boundary(sizes: dict[int, int], percent: int) -> int:
    """Largest small size: subsets of small sets against list entries of the others."""

    def cost(limit):
        return sum(c * (_enumerations(n, percent) if n <= limit else 2 * (n - kept_least(n, percent) + 1)) for n, c in sizes.items())

    return min(BOUNDARIES, key=cost)


def _subset_keys(s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and sizes of the set without each choice of so many shingles that it can miss."""
    h, n = mix(s), len(s)
    total, keys, sizes = h.sum(dtype=np.uint64), [], []
    for j in range(n - kept_least(n, percent) + 1):
        gone = np.array([h[list(c)].sum(dtype=np.uint64) if j else 0 for c in itertools.combinations(range(n), j)], np.uint64)
        keys.append(mix(total - gone + np.uint64(n - j)))
        sizes.append(np.full(len(gone), n - j))
    return np.concatenate(keys), np.concatenate(sizes)


ENTRY = pa.schema([("key", pa.uint64()), ("cls", pa.int64()), ("n", pa.int32()), ("k", pa.int32())])


def _entries(docs: DataFrame, heavy: np.ndarray, boundary: int, k: int, percent: int, parts: int) -> DataFrame:
    """Blocks of list entries (k = 0) and subset keys (k = size of the subset)."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    reach = kept_least(boundary + 1, percent)  # smaller sets cannot meet a large one

    def scan(batches):
        heavy = shared.value
        maybe = np.zeros(1 << 24, bool)
        maybe[(heavy & np.uint64((1 << 24) - 1)).astype(np.int64)] = True
        seen: set[int] = set()

        def entries(s, cls):
            n, out = len(s), []
            if n <= boundary:
                key, size = _subset_keys(s, percent)
                out.append((key, np.full(len(key), cls), np.full(len(key), n), size))
            if n >= reach:
                last = maybe[(s & np.uint64((1 << 24) - 1)).astype(np.int64)]
                at = np.flatnonzero(last)
                if len(at):
                    found = np.minimum(np.searchsorted(heavy, s[at]), len(heavy) - 1)
                    last[at] = heavy[found] == s[at]
                first = np.concatenate([s[~last], s[last]])[: n - kept_least(n, percent) + 1]
                out.append((first, np.full(len(first), cls), np.full(len(first), n), np.zeros(len(first), np.int64)))
            return out

        def tables():
            for batch in batches:
                got = []
                for s in shingle_sets(batch.column(0), k):
                    if len(s) and (cls := class_key(s)) not in seen:
                        seen.add(cls)
                        got += entries(s, cls)
                if got:
                    key, cls, n, size = (np.concatenate(c) for c in zip(*got))
                    columns = [pa.array(key), pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(size, pa.int32())]
                    yield (mix(key) % np.uint64(parts)).astype(np.int32), pa.Table.from_arrays(columns, schema=ENTRY)

        yield from scatter(tables())

    return docs.select("text").mapInArrow(thrifty(scan), BLOCK_DDL)


LIST_DDL = "kind int, key long, a long, b long, n int"


def _met(boundary: int, percent: int):
    """Of one destination: links from subsets (kind 0), candidates of neighbours in a list
    (1), and the members of the lists that neighbours do not cover (2)."""

    def out(kind, key, a, b, n):
        m = len(a)
        columns = [np.full(m, kind, np.int32), key, a, b, n.astype(np.int32)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["kind", "key", "a", "b", "n"])

    def meet(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        key, cls, n, k = (rows.column(c).to_numpy() for c in ENTRY.names)
        order = np.lexsort((cls, n, key))
        key, cls, n, k = key[order], cls[order], n[order], k[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        key, cls, n, k = key[new], cls[new], n[new], k[new]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(key)))
        first = np.repeat(head, size)
        many = np.repeat(size > 1, size)
        no = np.zeros(0, np.int64)
        # a member joins the smallest one of its subset: if any two of them link, so do these
        at = np.flatnonzero(many & (k > 0) & (first != np.arange(len(key))))
        at = at[100 * k[at].astype(np.int64) >= percent * (n[at] + n[first[at]] - k[at]).astype(np.int64)]
        links = out(0, np.zeros(len(at), np.int64), cls[at], cls[first[at]], n[at])
        lists = np.flatnonzero(many & (k == 0))
        pairs = [(no, no)]
        for step in range(1, NEIGHBOURS + 1):
            i = lists[: len(lists) - step] if len(lists) > step else no
            j = lists[step:]
            ok = (key[i] == key[j]) & (100 * n[i].astype(np.int64) >= percent * n[j].astype(np.int64)) & (n[j] > boundary)
            pairs.append((np.minimum(cls[i[ok]], cls[j[ok]]), np.maximum(cls[i[ok]], cls[j[ok]])))
        a, b = (np.concatenate(c) for c in zip(*pairs))
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        near = out(1, np.zeros(len(a), np.int64), a, b, np.zeros(len(a)))
        lists = np.flatnonzero(np.repeat(size > NEIGHBOURS + 1, size) & (k == 0))
        member = out(2, key[lists].view(np.int64), cls[lists], np.zeros(len(lists), np.int64), n[lists])
        return pa.concat_tables([links, near, member])

    return meet


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Places of the pairs that connect components, the most similar pairs first (Kruskal)."""
    names, at = np.unique(root, return_inverse=True)
    parent, kept = list(range(len(names))), []

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = np.argsort(weight, kind="stable")
    for k, a, b in zip(order.tolist(), at[i[order]].tolist(), at[j[order]].tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
            kept.append(k)
    return np.array(kept, np.int64)


def _crossing(boundary: int, percent: int, every: bool):
    """Pairs (a, b) of one list's members of different components that sizes and bitmaps allow:
    ``every`` one, or as many as connect what can be connected and the keys of lists with more."""

    def allowed(n, root, cells, bits):
        """Places (i, j) of allowed pairs of one list; members are in order of size, so the
        bitmaps of a pair have equal lengths, or the second one's is folded once. Of two members
        of different components at most one is in the list's largest, so only the other members
        are walked: a list that one component fills costs no pairs of that component."""
        names, size = np.unique(root, return_counts=True)
        largest = names[size.argmax()]
        for c in np.unique(cells):
            own, wide = np.flatnonzero(cells == c), np.flatnonzero(cells == 2 * c)
            members = np.concatenate([own, wide])
            most = root[members] == largest
            others = np.flatnonzero(~most)
            if not len(others):
                continue
            maps = np.frombuffer(b"".join(bits[i] for i in own), np.uint8).reshape(len(own), -1)
            if len(wide):
                double = np.frombuffer(b"".join(bits[i] for i in wide), np.uint8).reshape(len(wide), 2, -1)
                maps = np.concatenate([maps, double[:, 0] ^ double[:, 1]])
            most = np.flatnonzero(most[: len(own)])
            for at in others:
                before, after = most[: np.searchsorted(most, at)], np.arange(at + 1, len(members)) if at < len(own) else most[:0]
                with_ = np.concatenate([before, after])
                mine, i = members[at], members[with_]
                less, more = np.minimum(n[i], n[mine]), np.maximum(n[i], n[mine])
                ok = (more <= 100 * less // percent) & (more > boundary) & (root[i] != root[mine])
                i, near = i[ok], maps[with_[ok]]
                if len(i):
                    apart = np.bitwise_count(near ^ maps[at]).sum(1, dtype=np.int64)
                    ok = (100 + percent) * (n[i] + n[mine] - apart) >= 2 * percent * (n[i] + n[mine])
                    i, apart = i[ok], apart[ok]
                    yield np.full(len(i), mine), i, apart / (n[i] + n[mine])

    def chosen(lists, root):
        """All pairs, or the forest of them, in pieces of bounded size, and whether pairs are left out."""
        held, size, less = [], 0, False
        for piece in lists:
            held.append(piece)
            if (size := size + len(piece[0])) > 1_000_000:
                i, j, w = (np.concatenate(c) for c in zip(*held))
                if every:
                    yield i, j, False
                    held, size = [], 0
                else:
                    k = _forest(i, j, w, root)
                    less |= len(k) < len(i)
                    held, size = [(i[k], j[k], w[k])], len(k)
        if size:
            i, j, w = (np.concatenate(c) for c in zip(*held))
            k = np.arange(len(i)) if every else _forest(i, j, w, root)
            yield i[k], j[k], less or len(k) < len(i)

    def cross(group: pa.Table) -> pa.Table:
        rows = group.combine_chunks()
        key, cls, n, root = (rows.column(c).to_numpy() for c in ("key", "a", "n", "root"))
        order = np.lexsort((n, key))
        key, cls, n, root = key[order], cls[order], n[order].astype(np.int64), root[order]
        bits = rows.column("bits").take(pa.array(order)).to_pylist()
        cells = np.array([len(x) for x in bits])
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
        found, size, more = [np.zeros((2, 0), np.int64)], 0, []
        for lo, hi in zip(head, [*head[1:], len(key)]):
            if (root[lo:hi] == root[lo]).all():
                continue
            for i, j, less in chosen(allowed(n[lo:hi], root[lo:hi], cells[lo:hi], bits[lo:hi]), root[lo:hi]):
                if less:
                    more.append(key[lo])
                a, b = cls[lo + i], cls[lo + j]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                if (size := size + len(j)) > 2_000_000:
                    found, size = [np.unique(np.concatenate(found, axis=1), axis=1)], 0
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        pairs = pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "key": pa.nulls(len(a), pa.int64())})
        none = pa.nulls(len(more), pa.int64())
        return pa.concat_tables([pairs, pa.table({"a": none, "b": none, "key": pa.array(more, pa.int64())})])

    return cross


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose whole sets reach the similarity."""

    def allow(batches):
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))
            if n:
                yield batch.select(["a", "b"]).filter(pa.array([bits_allow(*c, percent) for c in zip(x, y, n, m)]))

    small = lambda c: classes.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    likely = stored(pairs.join(small("a"), "a").join(small("b"), "b").mapInArrow(thrifty(allow), "a long, b long"), "likely")
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))  # a null id is found like any other
    needed = likely.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(classes, "key").select(row_id.alias("doc_id"), "key")

    def shrunk(batches):
        for batch in batches:
            text = [zstandard.compress(t.as_buffer() if t.is_valid else b"", 1) for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.binary())], ["doc_id", "text"])

    def sets(column):
        return shingle_sets(pa.array([zstandard.decompress(t.as_buffer()) for t in column], pa.large_binary()), k)

    def keyed(batches):
        for batch in batches:
            keys = pa.array([class_key(s) for s in sets(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, batch.column(1)], ["doc_id", "key", "text"])

    # texts move once, compressed; only those of the wanted ids are cut into shingles
    texts = docs.select(row_id.alias("doc_id"), "text").mapInArrow(thrifty(shrunk), "doc_id long, text binary")
    texts = texts.join(needed.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(thrifty(keyed), "doc_id long, key long, text binary")
    texts = stored(texts.join(needed, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"]).select("key", "text"), "sets")
    side = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))

    def reach(batches):
        for batch in batches:
            hit = []
            for s, t in zip(sets(batch.column(2)), sets(batch.column(3))):
                both = len(np.intersect1d(s, t, assume_unique=True))
                hit.append(100 * both >= percent * (len(s) + len(t) - both))
            if hit:
                yield batch.select(["a", "b"]).filter(pa.array(hit))

    joined = likely.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(thrifty(reach), "a long, b long")


def _open_pairs(lists: DataFrame, found: DataFrame, classes: DataFrame, crossing, parts: int) -> DataFrame:
    """Rows (a, b, key) that ``crossing`` makes of lists with members of several components."""
    lists = lists.join(found.select(F.col("node").alias("a"), "root"), "a", "left")
    lists = lists.withColumn("root", F.coalesce("root", "a")).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    open_keys = lists.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("key")
    members = lists.join(open_keys, "key", "left_semi").join(classes.select(F.col("key").alias("a"), "bits"), "a")
    return members.groupBy("part").applyInArrow(thrifty_group(crossing), "a long, b long, key long")


def ngram_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, class_key (equal sets), component_id for every row of ``docs`` (doc_id, text)."""
    spark = tuned(docs.sparkSession)
    parts = parts_of(spark)
    profile = stored(_profile(docs, k), "profile")
    texts = profile.filter("kind = 0").withColumnRenamed("n", "n_shingles")
    rows = texts.select("doc_id", "key", "n_shingles")
    classes = stored(texts.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits")), "classes")
    sizes = {r[0]: r[1] for r in classes.filter(F.col("n") <= max(BOUNDARIES)).groupBy("n").count().collect()}
    boundary = _boundary(sizes, percent)
    blocks = _entries(docs, _heavy(profile), boundary, k, percent, parts)
    met = stored(blocks.groupBy("part").applyInArrow(thrifty_group(_met(boundary, percent)), LIST_DDL), "lists")
    swept(spark)
    first = stored(met.filter("kind = 1").select("a", "b").distinct(), "pairs")
    links = stored(met.filter("kind = 0").select("a", "b").union(_verified(docs, classes, first, k, percent)), "links")
    found = stored(components(links), "components")
    tested, lists = first, met.filter("kind = 2").select("key", "a", "n")
    for every in (False, True):
        swept(spark)
        crossed = stored(_open_pairs(lists, found, classes, _crossing(boundary, percent, every), parts), "crossed")
        # pairs of other lists have all been taken, or are inside a component
        lists = lists.join(crossed.filter("key IS NOT NULL").select("key"), "key", "left_semi")
        second = stored(crossed.filter("key IS NULL").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if second.isEmpty():
            continue
        more = stored(_verified(docs, classes, second, k, percent), "links")
        links, tested = stored(links.union(more), "links"), tested.union(second)
        if not more.isEmpty():
            found = stored(components(links), "components")
    swept(spark)
    root = rows.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    root = stored(root, "rooted")
    # written, so that the join below has a shuffle on either side and a large component is split
    least = stored(root.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return root.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.col("key").alias("class_key")
    )


def one_of_each_group(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of linked texts the smallest
    doc_id stays, once. Texts without a word are linked with nothing and stay; rows without a
    doc_id stay once per set of shingles, unless their group has a doc_id."""
    spark = tuned(docs.sparkSession)
    parts, schema, columns = parts_of(spark), docs.schema, docs.columns
    at_text, at_id = columns.index("text"), columns.index("doc_id")
    uid = F.xxhash64("_id", "_key")

    def keyed(batches):
        for batch in batches:
            keys = pa.array([class_key(s) for s in shingle_sets(batch.column(at_text), k)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(at_id).cast(pa.int64()), keys, *batch.columns], ["_id", "_key", *columns])

    ddl = "_id long, _key long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    rows = row_blocks(docs.mapInArrow(thrifty(keyed), ddl).select(uid.alias("_uid"), "_key", *[F.col(f"`{c}`") for c in columns]), parts)
    kept = ngram_components(docs, k, percent).filter("n_shingles = 0 OR doc_id <=> component_id")
    kept = kept.select(F.xxhash64("doc_id", "class_key").alias("_uid")).distinct()

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        table, wanted = unpack(left.column("block")), unpack(right.column("block"))
        if table is None or wanted is None:
            return empty
        uid, key = table.column("_uid").to_numpy(), table.column("_key").to_numpy()
        first = np.zeros(len(uid), bool)
        first[np.unique(uid, return_index=True)[1]] = True
        hit = np.isin(uid, wanted.column("_uid").to_numpy()) & (first | (key == 0))
        return table.filter(pa.array(hit)).select(columns)

    empty = to_arrow_schema(schema).empty_table()
    return rows.groupBy("part").cogroup(row_blocks(kept, parts).groupBy("part")).applyInArrow(thrifty_group(keep), schema)
