"""Toxicity by the nearest labelled examples.

Texts are vectors of letter trigrams inside words and of word starts, weighted by TF-IDF with
document counts over the whole corpus, kept in a fixed number of hashed slots.  The examples sit in an inverted index
whose lists are cut into blocks with their largest weight; whole blocks are
skipped when they cannot reach the nearest examples found so far, so cosines
are exact.  The nearest examples vote by distance.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from litsieve.llm.common import columns, memory_returned, mixed, return_memory, texts as text_rows, worker_value
from litsieve.session import release, stored

EXAMPLES_PER_LABEL = 1024
POSTINGS_PER_LABEL = 1 << 21  # the sample of a label is full when its texts have so many different terms in all
# Document counts lie in so many slots by the hash of the term, so their size does not grow with
# the corpus.  Terms that share a slot share its count: of v terms about v / SLOTS are touched.
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
OTHER_TERM = np.iinfo(np.int64).max
BLOCK = 64
COMMON = 8  # a term is common if one of so many examples holds it
FIRST_BLOCKS = 4
NEIGHBOURS = 20
START_LETTERS = 4
EVIDENCE = 5
NEAR = 0.05  # added to every distance, so that a copy counts much and not infinitely
THRESHOLD = 0.7

SCORES = "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, toxic: double>>"


def _letters() -> np.ndarray:
    return worker_value("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000), small=True)


def letter_terms(text: str | None, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Different terms of a text, sorted, and their counts.

    Terms are the trigrams of the lower-cased words, word ends included, and the
    first letters of every word.  Very long texts are counted piece by piece; a
    piece ends at white space.
    """
    keys, at = [], 0
    text = (text or "").lower()
    while at < len(text):
        end = at + piece
        while end < len(text) and not text[end].isspace():
            end += 1
        codes = np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), np.uint32)
        at = end
        letter = _letters()[codes]
        inside = letter.copy()
        inside[1:] |= letter[:-1]
        # One zero stands for any run of other characters, and for both ends.
        run = np.concatenate([[0], np.where(letter, codes, 0)[inside], np.zeros(START_LETTERS, np.int64)]).astype(np.int64)
        ends = len(run) - START_LETTERS + 1
        pairs = (run[:-1] << 21) | run[1:]
        middle = run[1:ends] != 0
        keys.append(((pairs[: ends - 1] << 21) | run[2 : ends + 1])[middle])
        first = np.flatnonzero((run[: ends - 1] == 0) & middle)
        # Letters after the end of a short word are left out of its start.
        a, b, c, d = (run[first + i] for i in range(1, START_LETTERS + 1))
        c = np.where(b == 0, 0, c)
        d = np.where(c == 0, 0, d)
        start = ((a * 0x9E3779B1 + b) * 0x85EBCA77 + c) * 0x27D4EB2F + d
        # Trigrams use 63 bits; the sign tells starts apart.
        keys.append(-1 - (start & 0x7FFFFFFFFFFFFFFF))
    return np.unique(np.concatenate(keys or [np.empty(0, np.int64)]), return_counts=True)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers of all ranges one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class BlockMaxIndex:
    """Inverted lists over the examples.

    Lists of common terms are cut into blocks of examples, each with its largest
    weight.  Short lists are read whole.  The blocks take at most
    ``8 * postings`` numbers, so the sample bounds them.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        term = np.concatenate([t for t, _ in vectors] or [np.empty(0, np.int64)])
        weight = np.concatenate([w for _, w in vectors] or [np.empty(0)])
        example = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        self.size = len(vectors)
        blocks = max(1, -(-self.size // BLOCK))
        common = np.bincount(term, minlength=terms) * COMMON >= max(1, self.size)
        self.place = np.where(common, np.cumsum(common) - 1, -1)
        in_block = common[term] if len(term) else np.empty(0, bool)
        self.dense = np.zeros((blocks, int(common.sum()), BLOCK), np.float32)
        of = example[in_block]
        self.dense[of // BLOCK, self.place[term[in_block]], of % BLOCK] = weight[in_block]
        self.largest = np.ascontiguousarray(self.dense.max(axis=2).T)
        order = np.lexsort((example[~in_block], term[~in_block]))
        self.example, self.weight = example[~in_block][order], weight[~in_block][order]
        self.lists = np.searchsorted(term[~in_block][order], np.arange(terms + 1))
        self.blocks = blocks

    def _add(self, scores: np.ndarray, blocks: np.ndarray, rows: np.ndarray, query: np.ndarray) -> None:
        if len(blocks):
            scores[blocks] += query @ self.dense[blocks[:, None], rows[None, :]]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine, largest first, and their cosines.

        Examples that share no term have cosine 0 and are no neighbours.
        """
        place = self.place[terms]
        rare = terms[place < 0]
        counts = self.lists[rare + 1] - self.lists[rare]
        postings = _ranges(self.lists[rare], counts)
        flat = np.bincount(self.example[postings], np.repeat(weights[place < 0], counts) * self.weight[postings], self.blocks * BLOCK).astype(np.float64)
        scores = flat.reshape(self.blocks, BLOCK)
        rows, query = place[place >= 0], weights[place >= 0].astype(np.float32)
        # No example of a block can have more than this.
        bound = query @ self.largest[rows] + scores.max(axis=1)
        by_bound = np.argsort(-bound, kind="stable")
        self._add(scores, by_bound[:FIRST_BLOCKS], rows, query)
        seen = scores[by_bound[:FIRST_BLOCKS]].ravel()
        if leave_out >= 0:
            seen = np.where(by_bound[:FIRST_BLOCKS].repeat(BLOCK) * BLOCK + np.tile(np.arange(BLOCK), len(seen) // BLOCK) == leave_out, 0, seen)
        least = np.partition(seen, -k)[-k] if len(seen) > k else 0.0
        # A bound and a cosine are rounded differently, hence the slack.
        rest = by_bound[FIRST_BLOCKS:]
        rest = rest[bound[rest] >= least - 1e-5]
        self._add(scores, rest, rows, query)
        reached = np.zeros(self.blocks, bool)
        reached[by_bound[:FIRST_BLOCKS]] = reached[rest] = True
        scores[~reached] = 0
        flat = scores.ravel()[: self.size]
        if leave_out >= 0:
            flat[leave_out] = 0
        best = np.argsort(-flat, kind="stable")[:k]
        best = best[flat[best] > 0]
        return best, np.minimum(flat[best], 1.0)


@dataclass
class Model:
    """Vocabulary, index and calibration; its size is bounded by the sample of examples and the slots."""

    vocabulary: np.ndarray
    idf: np.ndarray
    index: BlockMaxIndex
    doc_id: np.ndarray
    toxic: np.ndarray
    balance: float
    slope: float
    level: float
    prior: float

    def vector(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tf_idf(self.vocabulary, self.idf, keys, counts)

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        # Near examples weigh more, and both labels as if the sample had as many of each.
        weight = 1 / (NEAR + 1 - cosine)
        positive = self.balance * (weight * self.toxic[best]).sum()
        return float(positive / (positive + (weight * (1 - self.toxic[best])).sum()))

    def score(self, text: str | None) -> tuple[float, list[dict]]:
        best, cosine = self.index.nearest(*self.vector(*letter_terms(text)), NEIGHBOURS)
        if not len(best):
            return self.prior, []
        value = 1 / (1 + np.exp(-(self.slope * self.vote(best, cosine) + self.level)))
        evidence = [
            {"doc_id": int(self.doc_id[i]), "cosine": float(c), "toxic": float(self.toxic[i])}
            for i, c in zip(best[:EVIDENCE], cosine[:EVIDENCE])
        ]
        return float(value), evidence


def count_slots(keys: np.ndarray) -> np.ndarray:
    """Slot of each term's document count."""
    return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def tf_idf(vocabulary, idf, keys, counts) -> tuple[np.ndarray, np.ndarray]:
    """Places in the vocabulary and weights, of length 1 over all terms of the text.

    The last place of the vocabulary stands for every term that no example holds.
    """
    at = np.searchsorted(vocabulary, keys)
    weight = (1 + np.log(counts)) * idf[count_slots(keys)]
    return np.where(vocabulary[at] == keys, at, len(vocabulary) - 1), weight / (np.sqrt((weight**2).sum()) or 1.0)


def _held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [letter_terms(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("toxic"),
                pa.array([keys for keys, _ in found], pa.list_(pa.int64())),
                pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32())),
            ],
            names=["doc_id", "toxic", "grams", "counts"],
        )


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each term, by the terms' slots, and its documents under slot -1."""
    total, seen = 0, np.zeros(SLOTS, np.int64)
    for batch in batches:
        total += batch.num_rows
        for text in batch.column("text").to_pylist():
            np.add.at(seen, count_slots(letter_terms(text)[0]), 1)
    slots = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, slots], pa.int64()), pa.array(np.r_[total, seen[slots]], pa.int64())], names=["slot", "n"])


def _calibrated(votes: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and level of a logistic curve; both labels weigh as in all labelled rows."""
    share = min(max(toxic.mean(), 1e-6), 1 - 1e-6) if len(toxic) else 0.5
    weight = toxic * prior / share + (1 - toxic) * (1 - prior) / (1 - share)
    x = np.stack([votes, np.ones_like(votes)], axis=1)
    at = np.zeros(2)
    ridge = np.array([1e-3, 1e-6]) * max(1, len(votes))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (weight * (toxic - p)) - ridge * at
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        at = at + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES_PER_LABEL) -> Model:
    """Index a sample of labelled texts that are not held out, ``per_label`` of each label at most.

    The sample is the rows of smallest hash of their id among those whose text has a
    letter; texts of any length are taken, until the label's number of rows or of
    different terms is reached.  A doc_id that repeats stands for its smallest text.
    Document counts are those of all documents and lengths of vectors run over all terms
    of a text; the vocabulary lists only the terms of the examples.  Equal texts are one example, whose label is the mean of
    theirs.
    """
    spark = docs.sparkSession
    known = columns(labels, doc_id="long", toxic="double").where("toxic in (0, 1) and doc_id is not null").where(~_held_out())
    total, positive = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    prior = (positive + 1) / (total + 2)
    texts = text_rows(docs, doc_id="long", text="string")
    lettered = texts.where(F.col("text").rlike(r"\p{L}")).select("doc_id").distinct()
    drawn = known.select("doc_id", "toxic").distinct().join(lettered, "doc_id", "left_semi")
    taken = [drawn.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for v in (0, 1)]
    sample = taken[0].unionByName(taken[1])
    # Bounded: at most ``per_label`` rows of each label.
    found = stored(
        texts.join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .mapInArrow(memory_returned(_example_rows), "doc_id long, toxic double, grams array<long>, counts array<int>")
        .where("size(grams) > 0")
    )
    earlier = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.select("doc_id", "toxic", F.size("grams").alias("n"))
    full = F.coalesce(F.sum("n").over(earlier), F.lit(0)) >= POSTINGS_PER_LABEL
    open_rows = sizes.withColumn("full", full).where("not full").select("doc_id", "toxic")
    rows = found.join(F.broadcast(open_rows), ["doc_id", "toxic"]).select("doc_id", "toxic", "grams", "counts").toArrow()
    merged: dict[bytes, list] = {}
    lists = [[x.values.to_numpy() for x in rows.column(c)] for c in ("grams", "counts")]
    for doc_id, toxic, keys, n in sorted(zip(rows.column("doc_id").to_pylist(), rows.column("toxic").to_pylist(), *lists), key=lambda r: r[:2]):
        merged.setdefault(xxhash.xxh3_128_digest(keys.tobytes() + n.tobytes()), [doc_id, keys, n, []])[3].append(toxic)
    del lists, rows
    release(found)
    examples = list(merged.values())
    del merged
    # At most one row per slot.
    counted = texts.select("text").mapInArrow(memory_returned(_document_counts), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(SLOTS + 1, np.int64)
    df[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    del counted
    # Slot -1, the last one, has the number of documents.
    idf = (np.log((df[-1] + 1) / (np.minimum(df[:-1], df[-1]) + 1)) + 1e-6).astype(np.float32)
    vocabulary = np.unique(np.concatenate([[OTHER_TERM], *(e[1] for e in examples)]).astype(np.int64))
    vectors = [tf_idf(vocabulary, idf, e.pop(1), e.pop(1)) for e in examples]
    doc_id = np.array([e[0] for e in examples], np.int64)
    toxic = np.array([np.mean(e[1]) for e in examples])
    order = _similar_side_by_side(vectors, len(vocabulary))
    index = BlockMaxIndex([vectors[i] for i in order], len(vocabulary))
    balance = (len(toxic) - toxic.sum()) / toxic.sum() if 0 < toxic.sum() < len(toxic) else 1.0
    model = Model(vocabulary, idf, index, doc_id[order], toxic[order], balance, 1.0, 0.0, prior)
    votes = np.full(len(order), prior)
    for i, at in enumerate(order):
        best, cosine = index.nearest(*vectors[at], NEIGHBOURS, leave_out=i)
        if len(best):
            votes[i] = model.vote(best, cosine)
    model.slope, model.level = _calibrated(votes, model.toxic, prior)
    # What the tables of the fit took goes back to the system.
    del vectors
    return_memory()
    return model


def _similar_side_by_side(vectors, terms: int) -> np.ndarray:
    """Examples along the main direction of their vectors: blocks of like texts have low bounds elsewhere."""
    if not vectors:
        return np.empty(0, np.int64)
    term = np.concatenate([t for t, _ in vectors])
    weight = np.concatenate([w for _, w in vectors])
    row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    mean = np.bincount(term, weight, terms) / len(vectors)
    at = np.cos(np.arange(len(vectors)) + 1.0)
    for _ in range(30):
        at = at - at.mean()
        side = np.bincount(term, weight * at[row], terms) - mean * at.sum()
        at = np.bincount(row, weight * side[term], len(vectors)) - mean @ side
        at = at / (np.sqrt((at**2).sum()) or 1.0)
    return np.argsort(at, kind="stable")


def _shared(spark, model: Model) -> tuple:
    """The model for the workers, with its class: they may have no copy of this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex


def _received(shared, key: str) -> Model:
    """The model in a worker, unpacked once; a worker keeps one model."""
    return worker_value(("toxicity", key), lambda: pickle.loads(shared.value))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every document.

    The score is the calibrated chance of label 1; ``evidence`` lists the nearest
    examples.  Null texts, empty texts and texts without a known term get the share
    of label 1 among the labelled rows.  Equal texts get equal scores.  Repeated rows
    are scored one by one; a null doc_id stays and is not held out.
    """
    shared = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _received(*shared)
        for batch in batches:
            found = [own.score(text) for text in batch.column("text").to_pylist()]
            score = np.array([s for s, _ in found], np.float64)
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                    pa.array([e for _, e in found], kind),
                ],
                names=["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    marked = text_rows(docs, doc_id="long", text="string").select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "text")
    return marked.mapInArrow(memory_returned(run), SCORES)


def toxic_text(spark, model: Model):
    """Column function on texts: whether the score reaches the threshold."""
    shared = _shared(spark, model)

    @F.pandas_udf("boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _received(*shared)
        for texts in batches:
            yield pd.Series([own.score(text)[0] >= THRESHOLD for text in texts], dtype=bool)
        return_memory()

    return judged


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows and score every document."""
    return score_documents(docs, fit(docs, labels))
