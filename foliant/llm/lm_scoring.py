"""LM scoring: cross-entropy difference of two matched bigram models.

The target model is counted from the documents labelled as good, the background
model from all documents. Both share one vocabulary (all words of the corpus),
one order and one smoothing. The score of a document is the mean over its words
of the target model's loss less the background model's (nats; lower: closer to
the target).

Every word and every (history, word) pair has its own exact counts, at any size
of the corpus:

1. Words are counted by a grouped aggregation.
2. The ``VOCABULARY`` most frequent words, and up to ``2 ** BITS`` pairs that are
   frequent in a sample of rows together with their words, are broadcast with
   their exact counts over all documents. They only spare the exchange: results
   do not depend on which words and pairs these are.
3. Each document's other pairs, aggregated per document, are exchanged once: by
   the word, or by the pair where the word is broadcast. A task then holds all
   occurrences of its pairs (and of its words), so it counts them and gives each
   document its losses, which are summed by row.

Losses are summed in units of 2 ** -32 nats, so sums do not depend on order.

Defined results: null and empty texts have no words, losses null and score 0;
repeated rows are counted and scored as they come; labels without doc_id or for
unknown documents have no effect, a null doc_id is never labelled; with no good
label both models rest on the shared word counts; empty tables give an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import cut_words, fold_az, hash_spans, mix, small_batches, utf8
from foliant.session import materialize, release

VOCABULARY, BITS = 30_000, 20
#: Rows in which frequent pairs are looked for, and the occurrences there that make a pair one.
SAMPLE, FREQUENT = 10_000, 3
#: Weight of the word model inside the bigram model (a Dirichlet prior, in counts).
PRIOR = 20.0
#: Labels are broadcast up to so many good ids; more are joined by exchange, once.
BROADCAST_IDS = 2_000_000
#: Units of a nat in which losses are summed.
UNIT = float(1 << 32)
#: Rows that a task counts at once, beyond those of its last word.
CHUNK = 500_000
#: Names of words: a broadcast word's place, else its hash below zero.
_OTHER = np.uint64(1 << 63)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the n + 1 word offsets of the rows."""
    data, offsets = utf8(texts)
    data = fold_az(data)
    starts, lengths, word_at = cut_words(data, offsets)
    return hash_spans(data, starts, lengths), word_at


def _firsts(word_at: np.ndarray) -> np.ndarray:
    return word_at[:-1][np.diff(word_at) > 0]


def _lasts(word_at: np.ndarray) -> np.ndarray:
    return word_at[1:][np.diff(word_at) > 0] - 1


def _marks(batch, word_at: np.ndarray) -> np.ndarray:
    """Whether each word is the target's."""
    target = np.asarray(batch.column("target").to_numpy(zero_copy_only=False), bool)
    return np.repeat(target, np.diff(word_at))


def _word_counts(batches):
    """Words of the rows -> their counts in this part of the corpus."""
    hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["word", "n"])

    for batch in batches:
        own, n = np.unique(_words(batch.column("text"))[0], return_counts=True)
        keys, at = np.unique(np.concatenate([hashes, own]), return_inverse=True)
        merged = np.zeros(len(keys), np.int64)
        merged[at[:len(hashes)]] = counts
        merged[at[len(hashes):]] += n
        hashes, counts = keys, merged
        if len(hashes) > 1_000_000:
            yield out()
            hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(hashes):
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words of all documents."""
    return docs.select("text").mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _top(words: DataFrame, size: int) -> DataFrame:
    return words.orderBy(F.col("n").desc(), "word").limit(size).select("word")


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the most frequent words of all documents."""
    top = _top(word_counts(docs), size).toArrow()
    return np.sort(top.column("word").to_numpy().astype(np.int64).view(np.uint64))


def _pairs_of(batches):
    """Pairs of neighbours of the rows, once a batch with their counts."""
    for batch in batches:
        h, word_at = _words(batch.column("text"))
        inner = np.ones(len(h), bool)
        inner[_firsts(word_at)] = False
        at = np.flatnonzero(inner)
        pair, n = np.unique(np.stack([h[at - 1], h[at]]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(pair[1].view(np.int64)), pa.array(n)],
                                         ["v", "w", "n"])


def frequent_pairs(docs: DataFrame, size: int) -> DataFrame:
    """``v, w``: word pairs that are frequent in a sample of rows."""
    rows = docs.count()
    some = docs.select("text") if rows <= SAMPLE else docs.select("text").sample(SAMPLE / rows, 1)
    return some.mapInArrow(_pairs_of, "v bigint, w bigint, n bigint").groupBy("v", "w").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "v", "w").limit(size).select("v", "w")


def _key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64))


class Tables:
    """What is broadcast: exact counts of the frequent words and of the frequent pairs."""

    def __init__(self, hashes: np.ndarray, size: int, v: np.ndarray, w: np.ndarray):
        self.hashes, self.size = hashes, size  # of the broadcast words, sorted; number of all words
        key = _key(v, w)
        self.keys, at = np.unique(key, return_index=True)  # a pair that shares its key is not broadcast
        self.v, self.w = v[at], w[at]
        #: Cells: the pairs, the words, the words that precede another (last: none before), all words.
        self.ends = np.cumsum([len(self.keys), len(hashes), len(hashes) + 1, 1])

    def take(self, counts: np.ndarray) -> None:
        """Counts of all documents and of the target's, 2 rows of cells."""
        self.pairs, words, self.histories, totals = np.split(counts, self.ends[:-1], axis=1)
        self.totals = totals[:, 0]
        self.words = self.model(*words)

    def model(self, n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
        """Word probabilities of both models: own counts over a prior of the shared ones."""
        shared = (n0 + 1) / (self.totals[0] + max(self.size, 1))
        return np.stack([(n + self.size * shared) / max(t + self.size, 1) for n, t in zip((n0, n1), self.totals)])

    def names(self, h: np.ndarray) -> np.ndarray:
        other = (h | _OTHER).view(np.int64)
        if not len(self.hashes):
            return other
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, other)

    def cut(self, texts: pa.Array):
        """Name of the word before each word, of the word, and the word offsets."""
        h, word_at = _words(texts)
        w = self.names(h)
        v = np.empty_like(w)
        v[1:] = w[:-1]
        v[_firsts(word_at)] = len(self.hashes)
        return v, w, word_at

    def place(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Place of each pair among the frequent ones, or -1."""
        if not len(self.keys):
            return np.full(len(v), -1)
        key = _key(v, w)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.v[at] == v) & (self.w[at] == w), at, -1)


def _units(nats: np.ndarray) -> np.ndarray:
    return np.rint(nats * UNIT).astype(np.int64)


def _count(shared):
    """Rows with a mark of the target -> counts of the frequent pairs and words."""
    def run(batches):
        tables = shared.value
        total = np.zeros((2, tables.ends[-1]), np.int64)
        for batch in batches:
            v, w, word_at = tables.cut(batch.column("text"))
            at = tables.place(v, w)
            target = _marks(batch, word_at)
            for part, use in zip(total, (np.ones(len(w), bool), target)):
                pairs, words, histories, all_words = np.split(part, tables.ends[:-1])
                pairs += np.bincount(at[(at >= 0) & use], minlength=len(pairs))
                words += np.bincount(w[(w >= 0) & use], minlength=len(words))
                histories += np.bincount(v[(v >= 0) & use], minlength=len(histories))
                all_words += use.sum()
        used = np.flatnonzero(total[0])
        for i in range(0, len(used), 200_000):
            cell = used[i: i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[0][cell]), pa.array(total[1][cell])],
                                             ["cell", "background", "target"])
    return run


#: Kinds of rows without ``v``, by ``m`` (others: the row's words, ``w`` its doc_id).
_BACKGROUND, _TARGET = -1, -2


def _sent(shared):
    """Rows -> ``row, w, v, m``: each row's doc_id and number of words, its losses
    from the broadcast counts, and its other pairs (``m``: 4 * times + 2 if the
    last of the row is among them + 1 if the row is the target's)."""
    def run(batches):
        tables = shared.value
        place = TaskContext.get().partitionId() << 36
        pair_loss = _units(-np.log(tables.pairs + PRIOR * tables.words[:, tables.w]))
        history_loss = _units(np.log(tables.histories + PRIOR))
        for batch in batches:
            if not batch.num_rows:
                continue
            v, w, word_at = tables.cut(batch.column("text"))
            at = tables.place(v, w)
            n = np.diff(word_at)
            row = place + np.arange(len(n))
            place += len(n)
            rows, ws, ms = [row], [batch.column("doc_id")], [n]
            for model, kind in ((0, _BACKGROUND), (1, _TARGET)):
                loss = np.where(v >= 0, history_loss[model][np.maximum(v, 0)], 0)
                if len(tables.keys):
                    loss += np.where(at >= 0, pair_loss[model][np.maximum(at, 0)], 0)
                upto = np.concatenate([[0], np.cumsum(loss)])
                rows.append(row)
                ws.append(pa.array(upto[word_at[1:]] - upto[word_at[:-1]]))
                ms.append(np.full(len(n), kind))
            last = np.zeros(len(w), bool)
            last[_lasts(word_at)] = True
            target, of = _marks(batch, word_at), np.repeat(row, n)
            rest = np.flatnonzero(at < 0)
            rest = rest[np.lexsort((v[rest], w[rest], of[rest]))]
            if len(rest):
                of, v, w, last, target = of[rest], v[rest], w[rest], last[rest], target[rest]
                new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (w[1:] != w[:-1]) | (v[1:] != v[:-1])]))
                times = np.diff(np.append(new, len(rest)))
                m = 4 * times + 2 * np.logical_or.reduceat(last, new) + target[new]
                rows.append(of[new])
                ws.append(pa.array(w[new]))
                ms.append(m)
            heads = 3 * len(n)
            names = np.zeros(sum(map(len, rows)), np.int64)
            if len(rest):
                names[heads:] = v[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(rows)), pa.concat_arrays([c.cast(pa.int64()) for c in ws]),
                 pa.array(names, mask=np.arange(len(names)) < heads), pa.array(np.concatenate(ms))], ["row", "w", "v", "m"])
    return run


def _losses(tables: Tables, row, w, v, m):
    """Background and target losses that pairs in the order of words, with all their
    occurrences, give to their rows."""
    times, last, target = m >> 2, (m >> 1) & 1, m & 1
    word = np.concatenate([[True], w[1:] != w[:-1]])
    pair = word | np.concatenate([[True], v[1:] != v[:-1]])
    pairs, words = np.flatnonzero(pair), np.flatnonzero(word)
    of_pair, of_word = np.cumsum(pair) - 1, np.cumsum(word) - 1
    other = w < 0
    own = [times, times * target]
    model = np.where(other, tables.model(*[np.add.reduceat(x, words) for x in own])[:, of_word], 0.0)
    if len(tables.hashes):
        model = np.where(other, model, tables.words[:, np.maximum(w, 0)])
    out = []
    for i in (0, 1):
        loss = _units(-np.log(np.add.reduceat(own[i], pairs)[of_pair] + PRIOR * model[i])) * times
        before = times - last
        history = np.add.reduceat(before * target if i else before, words)[of_word]
        out.append(loss + np.where(other, _units(np.log(history + PRIOR)) * before, 0))
    return out


def _score(shared):
    """Sent rows in the order of ``w, v`` -> parts of the rows' results."""
    def run(batches):
        tables = shared.value
        held, rows = [], 0

        def out(row, doc_id, n, background, target):
            return pa.RecordBatch.from_arrays([row, doc_id, n, background, target],
                                              ["row", "doc_id", "n_words", "background", "target"])

        def pairs(table):
            got = [table.column(c).to_numpy() for c in ("row", "w", "v", "m")]
            losses = _losses(tables, *got)
            none = np.zeros(len(got[0]), np.int64)
            return out(pa.array(got[0]), pa.nulls(len(none), pa.int64()), pa.array(none), *map(pa.array, losses))

        def whole(table):
            """How many rows belong to groups that are complete."""
            w, v = table.column("w").to_numpy(), table.column("v").to_numpy()
            new = np.flatnonzero((w[1:] != w[:-1]) | ((w[1:] >= 0) & (v[1:] != v[:-1])))
            return int(new[-1]) + 1 if len(new) else 0

        need = CHUNK
        for batch in batches:
            heads = batch.column("v").is_null()
            if heads.true_count:
                head, batch = batch.filter(heads), batch.filter(pc.invert(heads))
                m = head.column("m").to_numpy()
                w = head.column("w")
                zero = np.zeros(len(m), np.int64)
                sums = w.fill_null(0).to_numpy()
                yield out(head.column("row"), pc.if_else(pa.array(m >= 0), w, pa.scalar(None, pa.int64())),
                          pa.array(np.maximum(m, 0)), *[pa.array(np.where(m == k, sums, zero)) for k in (_BACKGROUND, _TARGET)])
            held.append(batch)
            rows += batch.num_rows
            if rows >= need:
                table = pa.Table.from_batches(held).combine_chunks()
                n = whole(table)
                if n:
                    yield pairs(table.slice(0, n))
                held = table.slice(n).to_batches()
                rows -= n
                need = max(CHUNK, 2 * rows)
        if rows:
            yield pairs(pa.Table.from_batches(held).combine_chunks())
    return run


def tables_of(docs: DataFrame, vocabulary_size: int, bits: int) -> Tables:
    """The frequent words and pairs, still to be counted."""
    words = materialize(word_counts(docs))
    pairs = frequent_pairs(docs, 1 << bits).toArrow()
    v, w = (pairs.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("v", "w"))
    top = _top(words, vocabulary_size).toArrow().column("word").to_numpy().astype(np.int64).view(np.uint64)
    size = words.count()
    release(words)
    hashes = np.unique(np.concatenate([top, v, w]))
    return Tables(hashes, size, np.searchsorted(hashes, v), np.searchsorted(hashes, w))


def counted(marked: DataFrame, tables: Tables) -> np.ndarray:
    """Counts of all documents and of the good ones, 2 rows of cells."""
    shared = marked.sparkSession.sparkContext.broadcast(tables)
    sums = marked.mapInArrow(_count(shared), "cell int, background bigint, target bigint").groupBy("cell") \
        .agg(F.sum("background").alias("background"), F.sum("target").alias("target")).toArrow()
    out = np.zeros((2, tables.ends[-1]), np.int64)
    cell = sums.column("cell").to_numpy()
    out[0, cell], out[1, cell] = sums.column("background").to_numpy(), sums.column("target").to_numpy()
    return out


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, target, text``: whether each row is labelled as good."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    few = good.count() <= BROADCAST_IDS
    joined = docs.join(good.hint("broadcast" if few else "merge"), F.col("doc_id") == F.col("_good"), "left") \
        .select("doc_id", F.col("_good").isNotNull().alias("target"), "text")
    return joined if few else materialize(joined)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, vocabulary_size: int = VOCABULARY, bits: int = BITS) -> DataFrame:
    """``doc_id, n_words, background_loss, target_loss, score`` of every row of ``docs``
    (``doc_id, text``), with ``labels`` (``doc_id, quality``)."""
    small_batches(docs, 250)
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = _marked(docs, labels)
    tables = tables_of(docs, vocabulary_size, bits)
    tables.take(counted(marked, tables))
    shared = context.broadcast(tables)
    by = F.when(F.col("v").isNull(), F.xxhash64("row")).when(F.col("w") < 0, F.xxhash64("w")).otherwise(F.xxhash64("w", "v"))
    sent = marked.mapInArrow(_sent(shared), "row bigint, w bigint, v bigint, m bigint")
    parts = sent.repartition(by).sortWithinPartitions("w", "v").mapInArrow(
        _score(shared), "row bigint, doc_id bigint, n_words bigint, background bigint, target bigint")
    of_row = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_words", "background", "target")])
    means = [F.when(F.col("n_words") > 0, F.col(c) / UNIT / F.col("n_words")) for c in ("background", "target")]
    return of_row.select("doc_id", "n_words", means[0].alias("background_loss"), means[1].alias("target_loss"),
                         F.coalesce(means[1] - means[0], F.lit(0.0)).alias("score"))
