"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

Voters look at a text and vote toxic, clean or not at all. There is one for every word of a seed lexicon, one for
each word or stem (a word's first bytes) that stands out in the labelled sample, and some for patterns. The label model estimates by
EM, from labels that may be wrong, how often each voter votes either way given the hidden label and the vote of one other voter: of all
trees over the voters the one whose pairs tell most about each other given the label (Friedman et al., 1997). Voters that it finds to be
wrong more often than right are dropped. Its posteriors are the targets of a logistic regression on the voters,
on patterns and on hashed words, which scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import text as tx
from quillspark.llm.learn import labelled
from quillspark.llm.store import Scratch

#: Insults in several languages; each is a voter of its own.
LEXICON = (
    "idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown dumb fool jerk bastard filth vermin imbecile garbage "
    "idiota estupido estúpido imbécil basura asqueroso patético payaso tonto "
    "idioten dumm dummkopf trottel abschaum widerlich erbärmlich versager "
    "stupide imbécile ordure dégoûtant pathétique crétin racaille"
).split()
#: Short phrases as consecutive words.
PHRASES = ("you are nothing", "shut up", "go away", "hate you", "kill yourself")
BUCKETS = 1 << 16
PATTERNS = 3
#: Words and stems that stand out in the sample and become voters.
MINED = 256
#: Of texts, taken to be toxic where there are no labels; and the log odds of a voter that is right in 8 of 10 votes.
BALANCE, BELIEF = 0.05, 1.5
#: Bytes of a stem; a stem is shorter than its word.
STEMS = (4, 5, 6, 7)


def _hash_word(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return tx.hashes(data, np.array([0]), np.array([len(data)]))[0]


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.array([_hash_word(w) for w in words], dtype=np.uint64)


@dataclass
class Features:
    """Of a block of texts: words, stems (0: none), where each row's begin, and patterns from 0 to 1; how often each word occurs (None: once)."""

    h: np.ndarray
    at: np.ndarray
    stems: np.ndarray
    stems_at: np.ndarray
    patterns: np.ndarray
    many: np.ndarray | None = None

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's row and occurrences, and each row's words."""
        row = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        many = np.ones(len(self.h)) if self.many is None else self.many
        return row, many, np.bincount(row, weights=many, minlength=len(self.at) - 1)


def read(data: np.ndarray, offsets: np.ndarray) -> Features:
    """Letter runs, so that signs glued to a word don't hide it; shares of capitals, exclamation marks and phrases."""
    starts, lengths, at = tx.runs(data, offsets, tx.LETTER)
    h = tx.hashes(data, starts, lengths)
    stems = np.zeros((len(h), len(STEMS)), np.uint64)
    for k, size in enumerate(STEMS):
        longer = lengths > size
        stems[longer, k] = tx.hashes(data, starts[longer], np.full(int(longer.sum()), size)) ^ np.uint64(size)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    part = data[offsets[0] : offsets[-1]]
    count = lambda member: np.diff(np.concatenate(([0], np.cumsum(member)))[offsets - offsets[0]])
    upper, bang = count((part >= 65) & (part <= 90)) / size, count(part == 33) / size
    found = np.zeros(n)
    row = np.repeat(np.arange(n), np.diff(at))
    for phrase in PHRASES:
        want = _word_hashes(phrase.split())
        k = len(want)
        if len(h) >= k:
            hit = np.logical_and.reduce([h[j : len(h) - k + 1 + j] == want[j] for j in range(k)])
            hit &= row[: len(hit)] == row[k - 1 :]
            np.add.at(found, row[: len(hit)][hit], 1)
    return Features(h, at, stems.ravel(), at * len(STEMS), np.column_stack([upper > 0.5, bang > 0.05, found > 0]).astype(np.float64))


def presence(f: Features, vocabulary: np.ndarray) -> np.ndarray:
    """Rows x voters: whether the text has the word or stem. vocabulary must be sorted."""
    n = len(f.at) - 1
    out = np.zeros((n, len(vocabulary)), bool)
    for h, at in ((f.h, f.at), (f.stems, f.stems_at)):
        if len(vocabulary) and len(h):
            place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[place] == h)
            out[np.searchsorted(at, hit, side="right") - 1, place[hit]] = True
    return out


def votes(present: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """1 toxic, 0 clean, -1 none, for each text and voter: words and phrases vote toxic where they are, two voters vote clean where nothing of their kind is."""
    any_word = present.any(1)
    clean = [np.where(any_word, -1, 0), np.where(any_word | (patterns[:, 2] > 0) | (patterns[:, 1] > 0), -1, 0)]
    return np.column_stack([np.where(present, 1, -1), np.where(patterns > 0, 1, -1), *clean]).astype(np.int8)


def _tree(one_hot: np.ndarray, post: np.ndarray) -> np.ndarray:
    """Each voter's parent (-1: none) in the tree of largest mutual information given the label; pairs that chance explains are left out."""
    n, m, _ = one_hot.shape
    flat = one_hot.reshape(n, 3 * m)
    about = np.zeros((m, m))
    for w in (1 - post, post):
        joint = ((flat * w[:, None]).T @ flat).reshape(m, 3, m, 3) / n
        one = (flat * w[:, None]).sum(0).reshape(m, 3) / n
        with np.errstate(divide="ignore", invalid="ignore"):
            term = joint * np.log(joint * w.mean() / (one[:, :, None, None] * one[None, None]))
        about += np.nan_to_num(term, nan=0.0, posinf=0.0, neginf=0.0).sum((1, 3))
    np.fill_diagonal(about, 0)
    about[about * n < 13] = 0  # twice that is chi-squared with 8 degrees of freedom: 1 in 1000
    parent, best, free = np.full(m, -1), np.zeros(m), np.ones(m, bool)
    for _ in range(m):
        j = int(np.where(free, best, -1).argmax())
        free[j] = False
        near = free & (about[j] > best)
        best[near], parent[near] = about[j][near], j
    return parent


def label_model(cast: np.ndarray, balance: float, start: np.ndarray | None = None, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of toxic, each voter's accuracy when it votes, and its parent (-1: none).

    A voter votes v given label y, and given its parent's vote u, with probability theta[y, u, v], drawn towards theta[y, v] as by
    two more texts. EM starts from ``start``, labels that may be wrong here and there, or from voters that are right in 8 of 10 votes;
    many copies of one voter can outvote the rest in the latter. The tree is found from the start, and again when first estimates stand.
    """
    n, m = cast.shape
    one_hot = np.stack([cast == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    lean = np.where(cast == 1, BELIEF, np.where(cast == 0, -BELIEF, 0)).sum(1) + np.log(balance / (1 - balance))
    post = 1 / (1 + np.exp(-np.clip(lean, -30, 30))) if start is None else 0.8 * start + 0.1
    parent = np.full(m, -1)
    for r in range(rounds):
        mass = np.array([(1 - post).sum(), post.sum()])
        both = np.stack([1 - post, post])
        theta = np.einsum("yn,nmv->ymv", both, one_hot, optimize=True) + 0.1
        theta /= mass[:, None, None] + 0.3
        if r in (0, 8) and n > 1:
            parent = _tree(one_hot, post)
        lean = np.log((mass[1] + 1) / (mass[0] + 1)) + np.einsum("nmv,mv->n", one_hot[:, parent < 0], (np.log(theta[1]) - np.log(theta[0]))[parent < 0])
        for j in np.flatnonzero(parent >= 0):
            up = one_hot[:, parent[j]]
            pair = np.einsum("yn,nu,nv->yuv", both, up, one_hot[:, j], optimize=True)
            given = (pair + 2 * theta[:, j, None, :]) / (pair.sum(2, keepdims=True) + 2)
            lean += ((up @ (np.log(given[1]) - np.log(given[0]))) * one_hot[:, j]).sum(1)
        post = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
    share = post.mean()
    says, clean = (theta[1, :, 2] * share, theta[0, :, 2] * (1 - share)), (theta[0, :, 1] * (1 - share), theta[1, :, 1] * share)
    toxic_voter = says[0] + says[1] > clean[0] + clean[1]
    return post, np.where(toxic_voter, says[0] / (says[0] + says[1]), clean[0] / (clean[0] + clean[1])), parent


@dataclass
class Classifier:
    vocabulary: np.ndarray
    voters: np.ndarray
    hashed: np.ndarray
    bias: float

    def score(self, f: Features) -> np.ndarray:
        dense = _dense(f, self.vocabulary)
        return 1 / (1 + np.exp(-np.clip(self.bias + dense @ self.voters + _hashed_sum(f, self.hashed), -30, 30)))


def _dense(f: Features, vocabulary: np.ndarray) -> np.ndarray:
    present = presence(f, vocabulary)
    return np.column_stack([present, f.patterns, np.minimum(present.sum(1), 3), present.any(1)]).astype(np.float64)


def _hashed_sum(f: Features, weights: np.ndarray) -> np.ndarray:
    row, many, n = f.words()
    return np.bincount(row, weights=weights[f.h >> np.uint64(48)] * many, minlength=len(n)) / np.sqrt(np.maximum(n, 1))


def _alike(word: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """1 / how many texts of the sample have the same two least hashes of their words, as copies of one text have."""
    code = tx.mix(word.astype(np.uint64) + np.uint64(1))
    least = np.full((n, 2), 2**64 - 1, np.uint64)
    np.minimum.at(least[:, 0], row, code)
    np.minimum.at(least[:, 1], row, tx.mix(code))
    _, back, many = np.unique(least, axis=0, return_inverse=True, return_counts=True)
    return 1 / many[back.ravel()]


def _mine(kinds: np.ndarray, word: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Words and stems that mark toxic texts, those first that mark texts which few earlier ones do.

    word, row: each distinct word and stem of each text. Texts that a seed word already marks are set aside, and copies of a
    text count as one, so that words which merely stand beside an insult don't become voters.
    """
    copies = _alike(word, row, len(y))
    seeds = np.isin(kinds, _word_hashes(LEXICON))
    copies[row[seeds[word]]] = 0
    least = max(5.0, 0.01 * y.sum())
    toxic, all_ = (np.bincount(word, weights=w[row], minlength=len(kinds)) for w in (copies * y, copies))
    lift = np.log((toxic + 0.5) / ((copies * y).sum() + 1)) - np.log((all_ - toxic + 0.5) / ((copies * (1 - y)).sum() + 1))
    fit = (toxic >= least) & (toxic >= 0.8 * (all_ + 1)) & (lift > 3) & (kinds != 0)
    keep = fit[word]
    word, row = word[keep], row[keep]
    mined: list[int] = []
    weight = copies * y
    for _ in range(min(MINED, int(fit.sum()))):
        gain = np.bincount(word, weights=weight[row], minlength=len(kinds))
        gain[mined] = 0
        if gain.max() < 0.5:
            break
        mined.append(int(gain.argmax()))
        weight[row[word == mined[-1]]] *= 0.5
    return kinds[mined]


def unlabelled() -> Classifier:
    """Every word and pattern of the lexicon counts as a voter that is right in 8 of 10 votes."""
    vocabulary = np.unique(_word_hashes(LEXICON))
    voters = np.append(np.full(len(vocabulary) + PATTERNS, BELIEF), [0.0, 0.0])
    voters[len(vocabulary) : len(vocabulary) + PATTERNS - 1] = 0  # capitals and exclamation marks alone say too little
    return Classifier(vocabulary, voters, np.zeros(BUCKETS), float(np.log(BALANCE / (1 - BALANCE))))


def fit(f: Features, y: np.ndarray, steps: int = 200) -> Classifier:
    """Mines voters from the labels, fits the label model on all voters, then the classifier on its posteriors."""
    n = len(y)
    row, many, size = f.words()
    both = np.concatenate((f.h, f.stems)), np.concatenate((row, np.repeat(np.arange(n), np.diff(f.stems_at))))
    kinds, back = np.unique(both[0], return_inverse=True)
    mined = _mine(kinds, back, both[1], y)
    vocabulary = np.unique(np.concatenate([_word_hashes(LEXICON), mined]))
    balance = float((y.sum() + 1) / (n + 2))
    cast = votes(presence(f, vocabulary), f.patterns)
    right = label_model(cast, balance, y)[1][: len(vocabulary)]
    vocabulary = vocabulary[(right >= 0.5) | ~(cast[:, : len(vocabulary)] >= 0).any(0)]
    target = label_model(votes(presence(f, vocabulary), f.patterns), balance, y)[0]
    dense = _dense(f, vocabulary)
    voters, bias = np.zeros(dense.shape[1]), float(np.log(balance / (1 - balance)))
    bucket = (f.h >> np.uint64(48)).astype(np.int64)
    scale = 1 / np.sqrt(np.maximum(size, 1))
    model = Classifier(vocabulary, voters, np.zeros(BUCKETS), bias)
    speed = [np.full(dense.shape[1], 1e-6), np.full(BUCKETS, 1e-6), 1e-6]
    for _ in range(steps):
        lean = model.bias + dense @ model.voters + np.bincount(row, weights=model.hashed[bucket] * many, minlength=n) * scale
        miss = target - 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
        grad = dense.T @ miss / n - 1e-4 * model.voters, np.bincount(bucket, weights=(miss * scale)[row] * many, minlength=BUCKETS) / n - 1e-3 * model.hashed, miss.mean()
        for k, g in enumerate(grad):
            speed[k] = speed[k] + g**2
        model.voters += 0.5 * grad[0] / np.sqrt(speed[0])
        model.hashed += 0.02 * grad[1] / np.sqrt(speed[1])
        model.bias += 0.5 * grad[2] / np.sqrt(speed[2])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, *, rows: int = 4_000, threshold: float = 0.5) -> DataFrame:
    """Scores every whole text; learns from at most ``rows`` labelled documents that are not held out.

    docs needs doc_id and text, labels doc_id and toxic; other columns are ignored. held_out: a Boolean column over
    doc_id; null counts as false. Null texts count as empty; every row, repeated ones too, gets a score from 0 to 1.
    Without labelled rows the lexicon alone decides: its voters count as right in 8 of 10 votes and one text in 20 as
    toxic, so a text without any of its words scores 0.05. Returns doc_id, uid (names
    doc_id and text), held_out, score, predicted; an empty table gives no rows.
    """
    spark = docs.sparkSession
    store = Scratch(spark, "toxicity")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("uid"))
    chosen = labelled(labels, "toxic", held_out, rows)
    model = spark.sparkContext.broadcast(_learn(docs, chosen, rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            parts = [model.value.score(read(data, offsets[i : j + 1])) for i, j in tx.blocks(offsets)]
            got = np.concatenate(parts) if parts else np.empty(0)
            yield pa.record_batch([batch.column("doc_id"), batch.column("uid"), batch.column("held_out"), pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=["doc_id", "uid", "held_out", "score", "predicted"])

    held = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return store.finish(held.mapInArrow(tx.lean(score), "doc_id long, uid long, held_out boolean, score double, predicted int"))


def _words_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct letter-run hashes of the sampled texts and how often they occur, so that texts of any length reach the driver without their strings."""
    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        for i, j in tx.blocks(offsets):
            f = read(data, offsets[i : j + 1])
            lists = []
            for h, at in ((f.h, f.at), (f.stems, f.stems_at)):
                distinct, many = zip(*(np.unique(h[a:b], return_counts=True) for a, b in zip(at[:-1], at[1:])))
                cuts = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in distinct]))).astype(np.int32))
                lists.append(pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(distinct).view(np.int64))))
                if h is f.h:
                    times = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(many).astype(np.int32)))
            pattern = pa.FixedSizeListArray.from_arrays(pa.array(f.patterns.ravel()), PATTERNS).cast(pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("y").slice(i, j - i), *lists, times, pattern], names=["y", "h", "stems", "many", "patterns"])


def _learn(docs: DataFrame, chosen: DataFrame, rows: int) -> Classifier:
    # of a doc_id that several rows have, one text; the labelled sample bounds the rows
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by("text", "uid").alias("text"), F.first("y").alias("y"))
    got = sample.select("text", "y", "doc_id").mapInArrow(tx.lean(_words_only), "y int, h array<long>, stems array<long>, many array<int>, patterns array<double>").toArrow()
    if not got.num_rows:
        return unlabelled()
    got = got.take(np.lexsort((got["y"].to_numpy(), pc.list_value_length(got["h"]).to_numpy())))
    lists = []
    for name in ("h", "stems"):
        column = got[name].combine_chunks()
        lists += [column.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(np.diff(column.offsets.to_numpy()))))]
    many = got["many"].combine_chunks().flatten().to_numpy().astype(np.float64)
    return fit(Features(*lists, got["patterns"].combine_chunks().flatten().to_numpy().reshape(-1, PATTERNS), many), got["y"].to_numpy().astype(np.float64))
