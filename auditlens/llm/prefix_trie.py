"""Prefix trie of conversations from padded matrices of turn ids.

A turn is a 128-bit digest of its role and text, and its code points. Conversations are cut into
segments of ``SEGMENT`` turns, so no row grows with a conversation; a segment carries a digest of all
turns before it, and each such digest is the root of a trie of its own. Segments are range-partitioned
by (segment, digest before, turns, ends here or goes on, conversation), and a shard of bounded rows is
one matrix: turns get dense ids in digest order, rows are filled up with 0, sorted by lexsort, and the
column-wise changes between neighbours, OR-accumulated from the left, mark where nodes start. Every
aggregate of a node is a sum (or minimum) over its rows, taken by reduceat at each depth:

* a node has as many children as its rows start nodes one level deeper;
* its subtree has as many leaves as it has rows that end and whose next row does not go on from them;
* what sharing saves below it is the sum, over its rows, of the code points at those depths, from its
  own, at which the row agrees with the row before it.

Only nodes on the path of a shard's first or last row can reach over its edges. These, and nodes at a
depth where segments meet, are open: their parts are summed by node key, with corrections from the
first and last rows of neighbouring shards. What later segments add to a node is summed per
conversation first and travels with its earlier segments. The ids of conversations that end in an open
node are hashed as a stream of sorted pieces, so no list of them is ever held.

Defined results: rows without conv_id take no part; a null role or text is empty; turns of one number
(and repeated rows, which stay turns of their own) come in the order of their digests; a conversation
without rebuilt turns is a member of the root; an empty table gives an empty result; other columns are
ignored. Remainders have the sign of conv_id.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.packed import parts_of, stored, tuned

SEGMENT = 64
SHARD_ROWS = 20_000
TURN_ROWS = 200_000
PIECE_IDS = 4_096
HEADS, LONGEST = 100, 6
DIGEST = 16
EMPTY = hashlib.sha256(b"").hexdigest()
CLOSED, OPEN, ENDS, EDGE, ROW = range(5)

FIELDS = [("kind", pa.int32()), ("shard", pa.int32()), ("place", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
          ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
          ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ids", pa.binary()), ("seg", pa.int32()), ("high", pa.int64()), ("low", pa.int64()),
          ("turns", pa.binary()), ("chars", pa.binary()), ("goes_on", pa.int32())]
SCHEMA = pa.schema(FIELDS)
DDL = ", ".join(f"{name} {({pa.int32(): 'int', pa.int64(): 'long', pa.string(): 'string', pa.binary(): 'binary'})[kind]}" for name, kind in FIELDS)
MEASURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _batch(**columns) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in FIELDS], schema=SCHEMA)


def segment_digest(seg: int, turns: bytes) -> tuple[int, int]:
    return struct.unpack(">qq", hashlib.blake2b(struct.pack(">q", seg) + turns, digest_size=DIGEST).digest())


def node_key(seg: int, high: int, low: int, turns: bytes, j: int) -> bytes:
    """Key of the node after ``j`` turns of a segment; where segments meet both give the same."""
    if j == SEGMENT:
        a, b = segment_digest(seg, turns)
        return struct.pack(">qq", high ^ a, low ^ b)
    before = struct.pack(">qq", high, low)
    return before if j == 0 else hashlib.blake2b(b"in" + before + struct.pack(">q", seg) + turns[: DIGEST * j], digest_size=DIGEST).digest()


# -- rebuilt conversations ---------------------------------------------------------------------


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, digest, chars: turns by number from 0, without gathering a conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    parts = max(parts_of(turns.sparkSession), -(-conversations.count() // TURN_ROWS))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]

    def number(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            start = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            run = np.searchsorted(start, np.arange(len(ids)), "right") - 1
            pos = np.arange(len(ids)) - start[run]
            pos[run == 0] += n if ids[0] == last else 0
            last, n = ids[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(pos), *batch.columns[1:]], ["conv_id", "part", "pos", "digest", "chars"])

    sorted_turns = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "digest", "chars")
    local = stored(sorted_turns.mapInArrow(number, "conv_id long, part int, pos long, digest binary, chars long"), "turns")
    # a conversation that goes on from part to part is the first of a part: at most one per part
    spread = local.groupBy("part").agg(F.min("conv_id").alias("conv_id")).select("conv_id").distinct()
    runs = local.join(spread, "conv_id").groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).filter("before > 0")
    return local.join(stored(offsets, "offsets"), ["conv_id", "part"], "left").select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "chars")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, digest, chars of the rebuilt turns, and one row without digest per conversation."""
    head, given = F.col("conv_id") - F.col("conv_id") % HEADS, F.crc32(F.col("conv_id").cast("string").cast("binary")) % LONGEST
    turns = _numbered(conversations).withColumn("head", head).withColumn("given", given)
    heads = stored(turns.filter((F.col("conv_id") == F.col("head")) & (F.col("pos") < LONGEST - 1)).select("head", "pos", "digest", "chars"), "heads")
    lengths = heads.groupBy("head").agg(F.count("*").alias("have"))
    shift = F.least(F.col("given"), F.coalesce("have", F.lit(0))) - F.col("given")
    own = turns.filter(F.col("pos") >= F.col("given")).join(stored(lengths, "lengths"), "head", "left")
    convs = turns.filter("pos = 0").select("conv_id", "head", "given")
    first = convs.join(heads, "head").filter(F.col("pos") < F.col("given"))
    marks = convs.select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long"))
    return own.select("conv_id", (F.col("pos") + shift).cast("long").alias("pos"), "digest", "chars").union(first.select("conv_id", "pos", "digest", "chars")).union(marks)


def _segments(turns: DataFrame) -> DataFrame:
    """Rows of the tries: seg, high, low (digest of what comes before), turns, goes_on, conv_id, chars."""
    row = F.when(F.col("digest").isNotNull(), F.struct("pos", "digest", "chars"))
    cut = turns.groupBy("conv_id", F.floor(F.col("pos") / SEGMENT).cast("int").alias("seg")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    cut = cut.select("conv_id", "seg", F.col("rows.digest").alias("digests"), F.col("rows.chars").alias("chars"))

    def pack(batches):
        for batch in batches:
            seg, digests, chars = batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            turns = [b"".join(x) for x in digests.to_pylist()]
            n = [len(t) // DIGEST for t in turns]
            own = [segment_digest(s, t) if s or k == SEGMENT else (0, 0) for s, t, k in zip(seg, turns, n)]
            sizes = [np.array(c, "<i8").tobytes() for c in chars.to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(turns, pa.binary()), pa.array(sizes, pa.binary()),
                       pa.array([a for a, _ in own], pa.int64()), pa.array([b for _, b in own], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "seg", "n", "turns", "chars", "a", "b"])

    rows = stored(cut.mapInArrow(pack, "conv_id long, seg int, n int, turns binary, chars binary, a long, b long"), "segments")
    many = (F.col("seg") > 0) | (F.col("n") == SEGMENT)
    chain = Window.partitionBy("conv_id").orderBy("seg")
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    columns = lambda high, low, on: ["seg", high.alias("high"), low.alias("low"), "turns", on.cast("int").alias("goes_on"), "conv_id", "chars"]
    zero = F.lit(0).cast("long")
    short = rows.filter(~many).select(*columns(zero, zero, F.lit(0)))
    long = rows.filter(many).select(*columns(F.coalesce(F.bit_xor("a").over(earlier), zero), F.coalesce(F.bit_xor("b").over(earlier), zero), F.lead("seg").over(chain).isNotNull()))
    return short.union(long)


# -- one shard -----------------------------------------------------------------------------------


class Shard:
    """Sorted rows of one range as a padded matrix of turn ids, and where their nodes start."""

    def __init__(self, rows: pa.Table):
        column = lambda c: rows.column(c).to_numpy()
        turns, chars = rows.column("turns").to_pylist(), rows.column("chars").to_pylist()
        flat = np.frombuffer(b"".join(turns), ">u8").reshape(-1, 2)
        n = np.array([len(t) // DIGEST for t in turns], np.int64)
        order = np.lexsort((flat[:, 1], flat[:, 0]))
        ids = np.empty(len(flat), np.int32)
        ids[order] = np.cumsum(np.r_[True, (flat[order][1:] != flat[order][:-1]).any(1)][: len(flat)])
        width = int(n.max(initial=0))
        here = np.arange(1, width + 1) <= n[:, None]
        matrix, sizes = np.zeros((len(n), width), np.int32), np.zeros((len(n), width + 2), np.int64)
        matrix[here], sizes[:, 1:-1][here] = ids, np.frombuffer(b"".join(chars), "<i8")
        root = [column(c) for c in ("low", "high", "seg")]
        order = np.lexsort((column("conv_id"), column("goes_on"), *matrix.T[::-1], *root))
        matrix, self.sizes, self.n = matrix[order], sizes[order], n[order]
        self.turns, self.chars = [turns[i] for i in order], [chars[i] for i in order]
        self.low, self.high, self.seg = (c[order] for c in root)
        self.conv, self.goes_on = column("conv_id")[order], column("goes_on")[order]
        self.more = [column(c)[order] if c in rows.column_names else np.zeros(len(n), np.int64) for c in ("more_leaves", "more_saved")]
        other = np.ones((len(n), 1), bool)
        other[1:, 0] = (np.diff(self.low) != 0) | (np.diff(self.high) != 0) | (np.diff(self.seg) != 0)
        change = np.ones((len(n), width), bool)
        change[1:] = matrix[1:] != matrix[:-1]
        self.new = np.logical_or.accumulate(np.hstack([other, change, np.ones((len(n), 1), bool)]), axis=1)
        self.inside = np.hstack([np.ones((len(n), 1), bool), here[order], np.zeros((len(n), 1), bool)])
        shared = ~self.new & self.inside
        self.agree = shared[:, 1:].sum(1)
        on = np.zeros(len(n), bool)
        on[:-1] = shared[1:, 0] & (self.agree[1:] >= self.n[:-1])
        self.leaf = ((self.goes_on == 0) & ~on).astype(np.int64)
        self.saved = np.cumsum(np.where(shared, self.sizes, 0)[:, ::-1], axis=1)[:, ::-1]
        self.width = width

    def key(self, row: int, j: int) -> bytes:
        return node_key(int(self.seg[row]), int(self.high[row]), int(self.low[row]), self.turns[row], j)

    def edges(self, shard: int) -> pa.RecordBatch:
        """The first and the last row."""
        at = [0, len(self.n) - 1]
        return _batch(kind=[EDGE] * 2, shard=[shard] * 2, place=[0, 1], conv_id=self.conv[at], seg=self.seg[at], high=self.high[at], low=self.low[at],
                      turns=[self.turns[i] for i in at], chars=[self.chars[i] for i in at], goes_on=self.goes_on[at])

    def rows(self) -> pa.RecordBatch:
        """What each row adds to the nodes of earlier segments of its conversation."""
        return _batch(kind=np.full(len(self.n), ROW), conv_id=self.conv, seg=self.seg, n_leaves=self.leaf, saved_tokens=self.saved[:, 0])

    def nodes(self, shard: int):
        last = len(self.n)
        above = None
        for j in range(self.width + 1):
            start = np.flatnonzero(self.new[:, j])
            end = np.r_[start[1:], last]
            deeper = (self.new[:, j + 1] & self.inside[:, j + 1]).astype(np.int64)
            ends = ((self.n == j) & (self.goes_on == 0)).astype(np.int64)
            total = lambda values: np.add.reduceat(values, start)  # noqa: B023, E731
            least, children, leaves, saved = np.minimum.reduceat(self.conv, start), total(deeper), total(self.leaf + self.more[0]), total(self.saved[:, j] + self.more[1])
            ended, real = total(ends), self.inside[start, j]
            open_ = (start == 0) | (end == last) | (j in (0, SEGMENT))
            parent = np.searchsorted(above[0], start, "right") - 1 if j else None
            closed = np.flatnonzero(real & ~open_)
            if len(closed):
                up, keys = parent[closed], {}
                for p in np.unique(up[above[2][up]]):
                    keys[p] = self.key(int(above[0][p]), j - 1)
                hashes = [self.hash(int(start[i]), int(ended[i])) for i in closed]
                yield _batch(kind=np.full(len(closed), CLOSED), conv_id=least[closed], depth=self.seg[start[closed]].astype(np.int64) * SEGMENT + j,
                             parent_conv_id=pa.array(above[1][up], mask=above[2][up]), parent_key=[keys.get(p) for p in up], n_convs=(end - start)[closed],
                             n_children=children[closed], n_leaves=leaves[closed], saved_tokens=saved[closed], ends_sha256=hashes)
            for i in np.flatnonzero(real & open_):
                row, seg = int(start[i]), int(self.seg[start[i]])
                key = self.key(row, j)
                if j == 0 and seg:  # the node itself is counted where it ends the segment before
                    yield _batch(kind=[OPEN], key=[key], n_convs=[0], n_children=[children[i]], n_leaves=[0], saved_tokens=[0])
                    continue
                under = above[2][parent[i]] if j else False  # else the parent lies inside this shard, and so does the node
                yield _batch(kind=[OPEN], key=[key], parent_key=[self.key(row, j - 1) if under else None], conv_id=[least[i]], depth=[seg * SEGMENT + j],
                             parent_conv_id=[above[1][parent[i]] if j and not under else None], n_convs=[end[i] - row], n_children=[children[i]], n_leaves=[leaves[i]], saved_tokens=[saved[i]])
                for lo in range(row, row + int(ended[i]), PIECE_IDS):
                    ids = ",".join(map(str, self.conv[lo : min(lo + PIECE_IDS, row + int(ended[i]))].tolist()))
                    yield _batch(kind=[ENDS], shard=[shard], place=[(lo - row) // PIECE_IDS], key=[key], ids=[ids.encode()])
            above = start, least, open_

    def hash(self, row: int, n: int) -> str:
        return hashlib.sha256(",".join(map(str, self.conv[row : row + n].tolist())).encode()).hexdigest() if n else EMPTY


def _sharded(rows: DataFrame, nodes: bool) -> DataFrame:
    """Nodes (or rows), edges and pieces of all shards."""
    count = rows.count()
    shards = max(parts_of(rows.sparkSession), -(-count // SHARD_ROWS))

    def scan(batches):
        got = list(batches)  # one range of rows, each at most a segment
        if sum(b.num_rows for b in got):
            shard, number = Shard(pa.Table.from_batches(got)), TaskContext.get().partitionId()
            yield shard.edges(number)
            if nodes:
                yield from shard.nodes(number)
            else:
                yield shard.rows()

    return stored(rows.repartitionByRange(shards, "seg", "high", "low", "turns", "goes_on", "conv_id").mapInArrow(scan, DDL), "shards")


def _corrections(found: DataFrame, nodes: bool) -> DataFrame:
    """What the first row of a shard and the last row of the one before take from or add to sums
    that each shard made as if it had no neighbour."""
    fields = ["conv_id", "seg", "high", "low", "turns", "chars", "goes_on"]
    ends = found.filter(F.col("kind") == EDGE)
    order = Window.orderBy("shard", "place")  # two rows per shard
    pairs = ends.select("place", *[F.lag(c).over(order).alias(f"_{c}") for c in fields], *fields).filter("place = 0 AND _seg IS NOT NULL")

    def scan(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                same = all(r[c] == r[f"_{c}"] for c in ("seg", "high", "low"))
                if not same:
                    continue
                a, b = r["_turns"], r["turns"]
                most = min(len(a), len(b)) // DIGEST
                agree = next((j for j in range(most) if a[j * DIGEST : (j + 1) * DIGEST] != b[j * DIGEST : (j + 1) * DIGEST]), most)
                size = np.frombuffer(r["chars"], "<i8")[:agree]
                no_leaf = not r["_goes_on"] and agree == len(a) // DIGEST
                if not nodes:
                    out.append({"kind": ROW, "conv_id": r["conv_id"], "seg": r["seg"], "n_leaves": 0, "saved_tokens": int(size.sum())})
                    out.append({"kind": ROW, "conv_id": r["_conv_id"], "seg": r["seg"], "n_leaves": -int(no_leaf), "saved_tokens": 0})
                    continue
                for j in range(agree + 1):
                    inner = j == 0 and r["seg"]
                    saved = 0 if inner else int(size[max(j - 1, 0) :].sum())
                    key = node_key(r["seg"], r["high"], r["low"], b, j)
                    leaves = 0 if inner else -int(no_leaf)
                    out.append({"kind": OPEN, "key": key, "n_convs": 0, "n_children": -int(j < agree), "n_leaves": leaves, "saved_tokens": saved})
            yield pa.RecordBatch.from_pylist(out, SCHEMA)

    return pairs.drop("place").mapInArrow(scan, DDL)


def _hashes(pieces: DataFrame) -> DataFrame:
    """key, ends_sha256: the pieces of a node in the order of their shards, hashed as a stream."""

    def scan(batches):
        key, state = None, None
        for batch in batches:
            for here, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if here != key:
                    if state:
                        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": state.hexdigest()}])
                    key, state = here, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if state:
            yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": state.hexdigest()}])

    dealt = pieces.select("key", "shard", "place", "ids").repartition(parts_of(pieces.sparkSession), "key").sortWithinPartitions("key", "shard", "place")
    return dealt.select("key", "ids").mapInArrow(scan, "key binary, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations: ``turns`` has conv_id, pos (from 0), digest and chars, and
    a row without digest for every conversation."""
    tuned(turns.sparkSession)
    rows = stored(_segments(turns), "rows")
    deep = rows.filter("seg > 0")
    if not deep.isEmpty():
        below = _sharded(deep, nodes=False)
        parts = below.filter(F.col("kind") == ROW).unionByName(_corrections(below, nodes=False))
        each = parts.groupBy("conv_id", "seg").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        later = Window.partitionBy("conv_id").orderBy(F.desc("seg"))
        added = each.select("conv_id", (F.col("seg") - 1).alias("seg"), F.sum("leaves").over(later).alias("more_leaves"), F.sum("saved").over(later).alias("more_saved"))
        rows = rows.join(stored(added, "added"), ["conv_id", "seg"], "left").fillna(0, ["more_leaves", "more_saved"])
    found = _sharded(rows, nodes=True)
    kind = F.col("kind")
    parts = found.filter(kind == OPEN).unionByName(_corrections(found, nodes=True))
    sums = [F.sum(c).alias(c) for c in MEASURES]
    nodes = stored(parts.groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_conv_id").alias("inner_parent"), *sums), "open")
    ids = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_open"))
    ends = _hashes(found.filter(kind == ENDS))
    columns = ["conv_id", "depth", "parent_conv_id", *MEASURES, "ends_sha256"]
    wide = nodes.join(ends, "key", "left").join(ids, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("of_open", "inner_parent"))
    wide = wide.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    closed = found.filter(kind == CLOSED)
    known = closed.filter(F.col("parent_key").isNull())
    under = closed.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(ids.withColumnRenamed("of_open", "parent_conv_id"), "parent_key")
    return wide.select(columns).union(known.select(columns)).union(under.select(columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations of ``conversations`` (conv_id, turn, role, text)."""
    return trie(rebuilt(conversations))


ORACLE_SQL = """
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
    lambda state, byte: list_reduce(list_prepend(xor(state, byte), range(8)),
      lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)
), turns AS (
  SELECT c.conv_id, 0 AS own, n.pos, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.head AND n.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, n.pos, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos >= c.h
), paths AS (
  SELECT conv_id, length(text) AS chars, row_number() OVER w AS depth,
    string_agg(md5(length(role)::VARCHAR || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS path
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path
), nodes AS (
  SELECT path, depth, left(path, 32 * (depth - 1)) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * max(chars) AS saved
  FROM paths GROUP BY path, depth
), sized AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth > 0 AND c.up = n.path) AS n_children FROM nodes n
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  (SELECT count(*) FROM sized s WHERE s.n_children = 0 AND starts_with(s.path, n.path)) AS n_leaves,
  (SELECT sum(s.saved)::BIGINT FROM sized s WHERE starts_with(s.path, n.path)) AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM sized n LEFT JOIN sized p ON n.depth > 0 AND p.path = n.up AND p.depth = n.depth - 1 LEFT JOIN ends e ON e.path = n.path
"""
