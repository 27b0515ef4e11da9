"""Toxicity by two class-conditional Kneser-Ney models over the bytes of words.

The toxic and the ordinary model give the probability of each byte from up to ``ORDER - 1`` bytes
before it in its word (lower-cased A-Z, with a space at both ends). The longest context has counts
of the class, with absolute discounting; shorter ones have counts that both classes share, as
continuation counts (in how many different ways an expression is preceded). So a rare expression
that one class happens to lack is judged by what both share, and weighs little. A word's toxic
minus ordinary log-likelihood counts as far as it exceeds ``MARGIN``: the sampling noise of
ordinary words, which would add up over a long text, stays out. The text's statistic is the mean
per word, and a logistic curve turns it into a score.

Counts cover every labelled row of the training folds, and no expression is cut: discounts,
continuation counts and both models are computed over the whole tables. Each distinct word is
judged once by joins with them; the words with evidence then meet the texts that have them. A
fold of its own, never counted, fits the curve on at most ``CALIBRATION_ROWS`` rows.

Defined results: a null, empty or blank text has statistic 0; repeated rows get equal scores; if
the labels lack one of the classes every score is 0 (1 if all labels are toxic); several labels
of one doc_id count as toxic if one of them is; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import BLOCK, BLOCK_DDL, pack, parts_of, scatter, stored, tuned, unpack
from auditlens.llm.text import column_bytes, mix, slices, word_hashes

ORDER = 6
MARGIN = 2.5
CALIBRATION_ROWS = 20_000
PARTS = 16
#: Places in the filter of words with evidence: a fixed size, which changes no result.
PLACES = 1 << 24
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
GRAMS = pa.schema([("gram_order", pa.int32()), ("gram", pa.int64()), ("plain", pa.int64()), ("toxic", pa.int64())])
GRAMS_DDL = "gram_order int, gram long, plain long, toxic long"


def _low(k: int) -> np.int64:
    return np.int64((1 << (8 * k)) - 1)


def word_events(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For words: the 1- to ORDER-grams that end at each byte of " word ", the byte's place in
    it, and its word. The newest byte of a gram is its lowest one."""
    length = end - start + 2
    last = np.cumsum(length)
    word = np.repeat(np.arange(len(start)), length)
    place = np.arange(len(word)) - np.repeat(last - length, length)
    at = np.clip(np.repeat(start, length) + place - 1, 0, max(len(data) - 1, 0))
    b = _LOWER[data[at]].astype(np.int64) if len(word) else np.zeros(0, np.int64)
    b[last - 1] = b[last - length] = 32
    grams = [b]
    for k in range(2, ORDER + 1):
        longer = grams[-1].copy()
        longer[k - 1 :] |= b[: len(b) - k + 1] << np.int64(8 * (k - 1))
        grams.append(longer)
    return grams, place, word


def _distinct(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of consecutive texts, the text of each word, and which distinct one it is."""
    hashes, start, end, rows = word_hashes(data, offsets)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return start[first], end[first], np.repeat(np.arange(len(rows) - 1), np.diff(rows)), which


def _summed(key: np.ndarray, *values: np.ndarray):
    order = np.argsort(key, kind="stable")
    key = key[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[cut], *(np.add.reduceat(v[order], cut) if len(cut) else v[:0] for v in values)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram_order, gram, plain, toxic) over all rows of ``labelled`` (text, toxic)."""

    def count(batches):
        have = [[] for _ in range(ORDER)]

        def shrink():
            for k in range(ORDER):
                if have[k]:
                    have[k] = [_summed(*(np.concatenate(c) for c in zip(*have[k])))]

        size = 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offsets):
                part = data[offsets[lo] : offsets[hi]]
                start, end, row, which = _distinct(part, offsets[lo : hi + 1] - offsets[lo])
                toxic = np.bincount(which, label[lo:hi][row], minlength=len(start)).astype(np.int64)
                plain = np.bincount(which, minlength=len(start)) - toxic
                grams, place, word = word_events(part, start, end)
                for k in range(1, ORDER + 1):
                    fits = np.flatnonzero((place >= k - 1) & (place > 0))
                    have[k - 1].append(_summed(grams[k - 1][fits], plain[word[fits]], toxic[word[fits]]))
                size += 1
                if size % 16 == 0:
                    shrink()
        shrink()

        def tables():
            for k, parts in enumerate(have):
                for gram, plain, toxic in parts:
                    columns = [pa.array(np.full(len(gram), k + 1, np.int32)), pa.array(gram), pa.array(plain), pa.array(toxic)]
                    part = (mix(gram.view(np.uint64)) % np.uint64(PARTS)).astype(np.int32) + PARTS * k
                    yield part, pa.Table.from_arrays(columns, schema=GRAMS)

        yield from scatter(tables())

    def add(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        k = rows.column("gram_order")[0].as_py()
        gram, plain, toxic = _summed(*(rows.column(c).to_numpy() for c in ("gram", "plain", "toxic")))
        return pa.Table.from_arrays([pa.array(np.full(len(gram), k, np.int32)), pa.array(gram), pa.array(plain), pa.array(toxic)], schema=GRAMS)

    return labelled.select("text", "toxic").mapInArrow(count, BLOCK_DDL).groupBy("part").applyInArrow(add, GRAMS_DDL)


def models(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log ratios (gram_order, gram, ratio) of the expressions that judge a byte, and of the
    back-off weights (gram_order, context, back) of their contexts: ``kneser_ney`` over tables."""
    ratios, backs, shared = None, None, None
    of = lambda k: counts.filter(F.col("gram_order") == k).select("gram", "plain", "toxic")
    most = lambda n, d: F.greatest(F.col(n) - d, F.lit(0.0))
    for k in range(1, ORDER + 1):
        rows = of(k).withColumn("both", F.col("plain") + F.col("toxic"))
        if k == 1:
            total = rows.agg(F.sum("both")).first()[0] or 0
            shared = rows.select(F.col("gram").alias("suffix"), ((F.col("both") + 1) / (total + 256)).alias("lower"))
            continue
        opens = F.shiftright("gram", 8 * (k - 1)) == 32  # begins a word: nothing can precede it
        rows = rows.withColumn("judges", opens | F.lit(k == ORDER)).withColumn("context", F.shiftright("gram", 8))
        rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(int(_low(k - 1))))).join(shared, "suffix").drop("suffix")
        if k < ORDER:
            ways = of(k + 1).groupBy(F.col("gram").bitwiseAND(F.lit(int(_low(k)))).alias("gram")).agg(F.count("*").alias("ways"))
            rows = rows.join(ways, "gram", "left").withColumn("both", F.when(opens, F.col("both")).otherwise(F.coalesce("ways", F.lit(0)))).drop("ways")
        rows = stored(rows, "grams")
        among = {"both": F.lit(True), "plain": F.col("judges"), "toxic": F.col("judges")}
        n = rows.agg(*[F.count_if(ok & (F.col(c) == times)).alias(f"{c}{times}") for c, ok in among.items() for times in (1, 2)]).first()
        d = {c: n[f"{c}1"] / (n[f"{c}1"] + 2 * n[f"{c}2"]) if n[f"{c}1"] else 0.5 for c in among}
        sums = [F.sum(F.when(ok, F.col(c)).otherwise(0)).alias(f"{c}_all") for c, ok in among.items()]
        types = [F.count_if(ok & (F.col(c) > 0)).alias(f"{c}_types") for c, ok in among.items()]
        contexts = rows.groupBy("context").agg(*sums, *types, F.max("judges").alias("judged"))
        weights = [F.when(F.col(f"{c}_all") > 0, d[c] * F.col(f"{c}_types") / F.col(f"{c}_all")).otherwise(1.0).alias(f"{c}_weight") for c in among]
        contexts = stored(contexts.select("context", "judged", *[f"{c}_all" for c in among], *weights), "contexts")
        p = {c: F.when(F.col(f"{c}_all") > 0, most(c, d[c]) / F.col(f"{c}_all")).otherwise(0.0) + F.col(f"{c}_weight") * F.col("lower") for c in among}
        known = stored(rows.join(contexts.drop("judged"), "context").select("gram", "judges", p["both"].alias("p"), F.log(p["toxic"] / p["plain"]).alias("ratio")), "model")
        shared = known.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        ratio = known.filter("judges").select(F.lit(k).alias("gram_order"), "gram", "ratio")
        back = contexts.filter("judged").select(F.lit(k).alias("gram_order"), "context", F.log(F.col("toxic_weight") / F.col("plain_weight")).alias("back"))
        ratios, backs = (ratio, back) if ratios is None else (ratios.union(ratio), backs.union(back))
    return ratios, backs


SPELT = pa.schema([("word", pa.int64()), ("spelt", pa.binary())])


def word_evidence(docs: DataFrame, ratios: DataFrame, backs: DataFrame) -> DataFrame:
    """(word, evidence): the words of ``docs`` (text) whose log ratio exceeds the margin, by hash.
    Distinct words are dealt to destinations; each asks for its own distinct expressions."""
    parts = parts_of(docs.sparkSession)

    def distinct(batches):
        def tables():
            seen = np.zeros(0, np.uint64)
            for batch in batches:
                data, offsets = column_bytes(batch.column(0))
                for lo, hi in slices(offsets):
                    part = data[offsets[lo] : offsets[hi]]
                    hashes, start, end, _ = word_hashes(part, offsets[lo : hi + 1] - offsets[lo])
                    hashes, first = np.unique(hashes, return_index=True)
                    new = ~np.isin(hashes, seen)
                    raw = _LOWER[part].tobytes()
                    words = [raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())]
                    yield (mix(hashes[new]) % np.uint64(parts)).astype(np.int32), pa.table([pa.array(hashes[new].view(np.int64)), pa.array(words, pa.binary())], schema=SPELT)
                    seen = hashes[new] if len(seen) > 400_000 else np.concatenate([seen, hashes[new]])

        yield from scatter(tables())

    def once(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        first = np.unique(rows.column("word").to_numpy(), return_index=True)[1]
        return pa.table([group.column("part")[:1].cast(pa.int32()), pa.array([pack(rows.take(pa.array(first)))], pa.binary())], schema=BLOCK)

    def events(table: pa.Table):
        """Words, and for each order of the judging expressions: the expressions, and their words."""
        data, offsets = column_bytes(table.column("spelt"))
        for lo, hi in slices(offsets):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            grams, place, word = word_events(part, at[:-1], at[1:])
            top = np.minimum(place + 1, ORDER)
            for k in range(2, ORDER + 1):
                now = np.flatnonzero(top == k)
                yield k, grams[k - 1][now], lo + word[now]

    def asked(batches):
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                have: dict[int, list] = {}
                for k, gram, _ in events(unpack([block])):
                    have.setdefault(k, []).append(np.unique(gram))
                for k, some in have.items():
                    gram = np.unique(np.concatenate(some))
                    columns = [np.full(len(gram), part, np.int32), np.full(len(gram), k, np.int32), gram]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "gram_order", "gram"])

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        words = unpack(left.column("block"))
        if words is None:
            return pa.table({"word": pa.array([], pa.int64()), "evidence": pa.array([], pa.float64())})
        order, gram, value = (right.column(c).to_numpy() for c in ("gram_order", "gram", "value"))
        known = {}
        for k in range(2, ORDER + 1):
            at = np.flatnonzero(order == k)
            at = at[np.argsort(gram[at])]
            known[k] = gram[at], value[at]
        total = np.zeros(words.num_rows)
        for k, now, word in events(words):
            at = _find(known[k][0], now)
            total += np.bincount(word[at >= 0], known[k][1][at[at >= 0]], minlength=len(total))
        keep = total > MARGIN
        return pa.table({"word": pa.array(words.column("word").to_numpy()[keep]), "evidence": pa.array(total[keep] - MARGIN)})

    words = stored(docs.select("text").mapInArrow(distinct, BLOCK_DDL).groupBy("part").applyInArrow(once, BLOCK_DDL), "words")
    wanted = words.mapInArrow(asked, "part int, gram_order int, gram long").withColumn("context", F.shiftright("gram", 8))
    met = wanted.join(ratios, ["gram_order", "gram"], "left").join(backs, ["gram_order", "context"], "left")
    met = met.select("part", "gram_order", "gram", F.coalesce("ratio", "back").alias("value")).filter("value IS NOT NULL")
    return words.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(judge, "word long, evidence double")


def measured(docs: DataFrame, evidence: DataFrame) -> DataFrame:
    """doc_id, fold and statistic ``x`` of every row of ``docs`` (doc_id, fold, text)."""
    places = np.zeros(PLACES, bool)
    places[evidence.select(F.pmod("word", F.lit(PLACES)).cast("int").alias("at")).distinct().toArrow().column("at").to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(places))

    def listed(batches):
        maybe = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            data, offsets = column_bytes(batch.column(3))
            for lo, hi in slices(offsets):
                hashes, _, _, rows = word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                hit = np.flatnonzero(maybe[(hashes % np.uint64(PLACES)).astype(np.int64)])
                row = np.searchsorted(rows, hit, "right") - 1
                pairs, times = np.unique(np.stack([row.astype(np.uint64), hashes[hit]]), axis=1, return_counts=True)
                cut = np.searchsorted(pairs[0], np.arange(hi - lo + 1).astype(np.uint64))
                have = [pa.LargeListArray.from_arrays(pa.array(cut, pa.int64()), pa.array(v, pa.int64())).cast(pa.list_(pa.int64())) for v in (pairs[1].view(np.int64), times)]
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(np.diff(rows), pa.int64()), *have], ["uid", "doc_id", "fold", "n", "words", "times"])

    keyed = docs.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "fold", "text")
    rows = stored(keyed.mapInArrow(listed, "uid long, doc_id long, fold int, n long, words array<long>, times array<long>"), "text-words")
    pairs = rows.filter(F.size("words") > 0).select("uid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("uid", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    sums = pairs.distinct().join(evidence, "word").groupBy("uid").agg(F.sum(F.col("times") * F.col("evidence")).alias("sum"))
    x = F.coalesce("sum", F.lit(0.0)) / F.greatest("n", F.lit(1))
    return rows.select("uid", "doc_id", "fold", "n").join(sums, "uid", "left").select("doc_id", "fold", x.alias("x"))


def kneser_ney(order: np.ndarray, gram: np.ndarray, plain: np.ndarray, toxic: np.ndarray) -> dict:
    """``models`` of small counts in memory, as tables for lookup: log ratios of the expressions
    that judge a byte, and of the back-off weights of their contexts for bytes that never
    followed them."""
    raw, shared = {}, {}
    model: dict = {"grams": {}, "ratio": {}, "contexts": {}, "back": {}}
    for k in range(1, ORDER + 1):
        at = np.flatnonzero(order == k)
        at = at[np.argsort(gram[at])]
        raw[k] = gram[at], np.stack([plain[at], toxic[at]]).astype(float)
    for k in range(1, ORDER + 1):
        key, n = raw[k]
        opens = (key >> np.int64(8 * (k - 1))) == 32  # begins a word: nothing can precede it
        if k == 1:
            both = n.sum(0)
            shared[k] = (both + 1) / (both.sum() + 256)
            continue
        lower = _below(raw, shared, key & _low(k - 1), k - 1)
        # shared counts: of both classes, and ways of being preceded below the top order
        both = n.sum(0)
        if k < ORDER:
            at = _find(key, raw[k + 1][0] & _low(k))
            both = np.where(opens, both, np.bincount(at[at >= 0], minlength=len(key)))
        own, weight, which, _ = _discounted(key, both)
        shared[k] = own + weight[which] * lower
        judges = opens | (k == ORDER)
        p, back = [], []
        for c in (0, 1):
            own, weight, which, context = _discounted(key[judges], n[c][judges])
            p.append(own + weight[which] * lower[judges])
            back.append(weight)
        model["grams"][k], model["ratio"][k] = key[judges], np.log(p[1] / p[0])
        model["contexts"][k], model["back"][k] = context, np.log(back[1] / back[0])
    return model


def _discounted(key: np.ndarray, n: np.ndarray):
    """Discounted share of each expression in its context, the weight left for shorter
    contexts, which context each expression has, and the contexts."""
    context, which = np.unique(key >> np.int64(8), return_inverse=True)
    once, twice = (n == 1).sum(), (n == 2).sum()
    d = once / (once + 2 * twice) if once else 0.5
    total, types = np.bincount(which, n, len(context)), np.bincount(which, n > 0, len(context))
    seen = total > 0
    weight = np.where(seen, d * types / np.where(seen, total, 1), 1.0)
    own = np.where(seen[which], np.maximum(n - d, 0) / np.where(seen, total, 1)[which], 0.0)
    return own, weight, which, context


def _below(raw: dict, shared: dict, key: np.ndarray, k: int) -> np.ndarray:
    """Shared probability at order k, or at the next order that knows the expression."""
    out, todo = np.full(len(key), 1 / 256), np.arange(len(key))
    for j in range(k, 0, -1):
        at = _find(raw[j][0], key[todo] & _low(j))
        out[todo[at >= 0]] = shared[j][at[at >= 0]]
        todo = todo[at < 0]
    return out


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, -1 if it is not there."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


def log_ratios(model: dict, grams: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """Toxic minus ordinary log probability of each byte of " word "; 0 for the first. Below the
    longest context both models are the shared one, so only its weight differs."""
    out, top = np.zeros(len(place)), np.minimum(place + 1, ORDER)
    for k in range(2, ORDER + 1):
        now = np.flatnonzero(top == k)
        at = _find(model["grams"][k], grams[k - 1][now])
        out[now[at >= 0]] = model["ratio"][k][at[at >= 0]]
        missing = now[at < 0]
        at = _find(model["contexts"][k], grams[k - 1][missing] >> np.int64(8))
        out[missing[at >= 0]] = model["back"][k][at[at >= 0]]
    return out


def statistics(model: dict, column: pa.Array) -> np.ndarray:
    """Mean toxic evidence per word of each text: what a word's log ratio has above the margin."""
    data, offsets = column_bytes(column)
    out = [np.zeros(0)]
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        start, end, row, which = _distinct(part, offsets[lo : hi + 1] - offsets[lo])
        grams, place, word = word_events(part, start, end)
        evidence = np.maximum(np.bincount(word, log_ratios(model, grams, place), minlength=len(start)) - MARGIN, 0)
        out.append(np.bincount(row, evidence[which], minlength=hi - lo) / np.maximum(np.bincount(row, minlength=hi - lo), 1))
    return np.concatenate(out)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps; a small pull to 0 keeps separable data finite."""
    scale = x.std() or 1.0
    z, w = np.stack([x / scale, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-w @ z))
        grad = z @ (y - p) - 0.02 * w
        step = np.linalg.solve((z * (p * (1 - p))) @ z.T + 0.02 * np.eye(2), grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[0] / scale, w[1]


def _curve(own: DataFrame) -> tuple[float, float]:
    """Logistic curve over a hash sample of labelled rows that the model did not count."""
    n = own.count()
    if n > CALIBRATION_ROWS:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * CALIBRATION_ROWS / n))
    fitted = own.select("x", "toxic").toPandas()
    y = fitted["toxic"].to_numpy(float)
    return logistic(fitted["x"].to_numpy(float), y) if 0 < y.sum() < len(y) else (100.0, -1.0)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistic of every row of ``docs`` (doc_id, text)."""
    tuned(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    fold = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)).cast("int")
    toxic = labels.filter("toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    rows = docs.select(doc_id.alias("doc_id"), fold.alias("fold"), "text")
    labelled = rows.filter("fold NOT IN (0, 4)").join(toxic.hint("merge"), "doc_id")
    counts = stored(gram_counts(labelled), "gram-counts")
    known = counts.filter("gram_order = 1").agg(F.coalesce(F.sum("plain"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if all(known):
        evidence = stored(word_evidence(rows, *models(counts)), "word-evidence")
        found = stored(measured(rows, evidence), "measured")
        slope, intercept = _curve(found.filter("fold = 4").join(toxic.hint("merge"), "doc_id"))
    else:
        found = rows.select("doc_id", "fold", F.lit(0.0).alias("x"))
        slope, intercept = 0.0, 500.0 if known[1] else -500.0
    score = 1 / (1 + F.exp(-F.greatest(F.least(F.col("x") * float(slope) + float(intercept), F.lit(500.0)), F.lit(-500.0))))
    found = found.withColumn("score", score)
    return found.select("doc_id", (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("x").alias("mean_evidence"))
