"""A log-bilinear language model trained by noise-contrastive estimation in numpy.

Tokens are the lower-cased words of a text and one end. The corpus is read once
into blocks: a block holds the token sequence of a few megabytes of text as
places in its own vocabulary, so later passes neither read nor split texts.

* Counts: the words of a block are dealt to buckets by hash, as many buckets as
  there are words for; a bucket adds up its words over all training documents.
* Classes: the most frequent words are classes of their own, all others fall
  into classes by the hash of their last two bytes.
* Network: the sum of the context classes' vectors, each scaled by a vector of
  its distance, is multiplied with the vectors of all classes. Training uses
  noise-contrastive estimation with noise from the class counts. All training
  documents are used: each task runs over its blocks, and the tasks' models are
  averaged, once after a first share of the blocks and once after the rest.
* Words: every word of a shared class, however rare, has two vectors of its own.
  One is for the word as prediction: multiplied with the vector of the class
  before it, it moves the word's smoothed share of its class. The other is for the word
  as context: multiplied with the vectors of all classes, it moves the
  network's prediction of the class that follows. Both are found by
  noise-contrastive estimation from all of the word's occurrences, with the
  expected noise in place of drawn noise, so each bucket trains its words alone.
  Words never seen in training have vectors of zero.
* Scores: products of a batch of contexts with all classes, normalised by their
  sum, give the log-probability of every token's class. The weights of all words
  of a class are added up over the buckets for each class before it, and a word's
  weight is divided by that sum. So the probabilities of all words add up to one
  with one unseen word per shared class.

Null and empty texts have the end as only token. A null id is read as the empty
text when documents are told apart, each row is scored, also repeated ones, and
extra columns are ignored. Without training documents every count is zero and
the classes keep their smoothed start. An empty table gives an empty result.
"""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.words import chunks, mixed, words
from caseframe.llm.work import array_sum, small_batches, texts, written

FREQUENT = 96
SHARED = 32
CONTEXT = 3
WIDTH = 16
NOISE = 32
BATCH = 4096
RATE = 0.1
BLOCK_BYTES = 4 << 20
END = np.uint64(0x0E5D_0F7E_87AB_CDEF)
_FIRST_SHARE = 4
#: Words of blocks in a bucket, about, and words trained or tokens scored at a time.
BUCKET_WORDS = 400_000
_SOME = 512
#: Numbers in a word's own vectors, steps towards them, the weight that holds them at zero,
#: and the parts of one in which they are kept.
WORD_WIDTH = 16
STEPS = 5
PRIOR = 10.0
FINE = 8
#: What a bucket tells a block of each of its words.
_ANSWER = np.dtype(
    [("class", "u1"), ("n", "<i8"), ("before", "i1", WORD_WIDTH), ("after", "i1", WORD_WIDTH)]
)

_BLOCK = (
    "block long, n_distinct long, vocabulary binary, shared binary, tokens binary,"
    " n_words binary, doc_ids array<long>, held_out binary"
)
_COUNTED = "bucket int, words binary, shared binary, n binary"
_SUMMED = "word long, shared int, n long, n_distinct long"
_ASKED = "block long, bucket int, words binary, classes binary, before binary, after binary"
_ANSWERED = "block long, bucket int, answer binary, weights binary"
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


def _block(block: int, part, data, offsets, shared: int) -> pa.RecordBatch:
    found = words(data, offsets)
    n_words = np.diff(found.first)
    ends = found.first[1:] + np.arange(len(n_words))
    tokens = np.empty(len(found.hashes) + len(n_words), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = END, found.hashes
    vocabulary, first, places = np.unique(tokens, return_index=True, return_inverse=True)
    last = np.zeros(len(tokens), np.uint64)
    before = np.maximum(found.ends - 2, found.starts)
    last[~is_end] = data[found.ends - 1].astype(np.uint64) << np.uint64(8) | data[before]
    kind = (mixed(last[first]) % np.uint64(shared)).astype(np.uint8)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()),
            pa.array([len(vocabulary)], pa.int64()),
            pa.array([vocabulary.tobytes()], pa.binary()),
            pa.array([kind.tobytes()], pa.binary()),
            pa.array([_deflated(places.astype(_place_type(len(vocabulary))))], pa.binary()),
            pa.array([n_words.astype(np.int64).tobytes()], pa.binary()),
            pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([np.array(part.column("held_out").to_pylist(), bool).tobytes()], pa.binary()),
        ],
        _names(_BLOCK),
    )


def _deflated(numbers: np.ndarray) -> bytes:
    """Numbers deflated, the first byte of each before the second of each, and so on."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T
    return zlib.compress(planes.tobytes(), 1)


def _inflated(value: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(value), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _place_type(count: int):
    """Places below ``count`` take as few bytes as hold them."""
    return np.uint16 if count <= 1 << 16 else np.uint32


def _blocks(size: int, shared: int):
    def run(batches):
        # Ids hold for good because the blocks are written before they are used.
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, data, offsets in chunks(batch, size=size):
                yield _block(number, part, data, offsets, shared)
                number += 1

    return run


class Block:
    """One row of the block table as arrays."""

    def __init__(self, row: dict):
        self.n_distinct = row["n_distinct"]
        if "vocabulary" in row:
            self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
            self.shared = np.frombuffer(row["shared"], np.uint8)
        self.tokens = _inflated(row["tokens"], _place_type(self.n_distinct))
        self.n_tokens = np.frombuffer(row["n_words"], np.int64) + 1
        self.held_out = np.frombuffer(row["held_out"], bool)
        self.document = np.repeat(np.arange(len(self.n_tokens), dtype=np.int32), self.n_tokens)

    def classes(self, frequent: np.ndarray) -> np.ndarray:
        """Class of each word of the vocabulary, in two bytes: a token has several of them."""
        at = np.minimum(np.searchsorted(frequent, self.vocabulary), len(frequent) - 1)
        return np.where(
            frequent[at] == self.vocabulary, at, len(frequent) + self.shared.astype(np.int64)
        ).astype(np.int16)

    def contexts(self, classes: np.ndarray, start: int) -> np.ndarray:
        """Classes of the tokens before each token, nearest first; ``start`` before a text."""
        of_token = classes[self.tokens]
        result = np.full((len(of_token), CONTEXT), start, np.int16)
        for back in range(1, CONTEXT + 1):
            inside = self.document[back:] == self.document[: -back or None]
            result[back:, back - 1] = np.where(inside, of_token[: len(of_token) - back], start)
        return result


def _rows(batch: pa.RecordBatch):
    """Rows of a batch as dicts, one at a time; lists of numbers as arrays."""
    for at in range(batch.num_rows):
        row = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            value = column[at]
            row[name] = value.values if isinstance(value, pa.ListScalar) else value.as_py()
        yield row


def _cut(words: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, first and end of each stretch of the sorted hashes that is in one bucket."""
    if not len(words):
        return []
    # Buckets are ranges of the hashes, so that sorted words are sorted by bucket.
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    return list(zip(bucket[first].tolist(), first, [*first[1:], len(words)], strict=True))


def _binaries(values) -> pa.Array:
    return pa.array([value.tobytes() for value in values], pa.binary())


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    """The arrays of a binary column one after another."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _counted(buckets: int):
    """The words that training documents of a block have, and how often, by bucket."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row)
                trained = ~block.held_out[block.document]
                n = np.bincount(block.tokens[trained], minlength=len(block.vocabulary))
                places = np.flatnonzero(n)
                cuts = _cut(block.vocabulary[places], buckets)
                spans = [places[first:end] for _, first, end in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([bucket for bucket, _, _ in cuts], pa.int32()),
                        _binaries(block.vocabulary[span] for span in spans),
                        _binaries(block.shared[span] for span in spans),
                        _binaries(n[span].astype(np.int64) for span in spans),
                    ],
                    _names(_COUNTED),
                )

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The most frequent words of a bucket and the end, then sums by shared class without a word."""
    words, shared = _joined(table, "words", np.uint64), _joined(table, "shared", np.uint8)
    words, first, places = np.unique(words, return_index=True, return_inverse=True)
    shared = shared[first].astype(np.int32)
    n = np.bincount(places, _joined(table, "n", np.int64)).astype(np.int64)
    signed = words.view(np.int64)
    top = np.lexsort((signed, -n))[:FREQUENT]
    top = np.union1d(top, np.flatnonzero(words == END))
    kinds = np.unique(shared)
    nothing = [None] * len(top)
    return pa.table(
        {
            "word": pa.array([*signed[top].tolist(), *[None] * len(kinds)], pa.int64()),
            "shared": pa.array([*shared[top].tolist(), *kinds.tolist()], pa.int32()),
            "n": pa.array(
                [*n[top].tolist(), *(int(n[shared == kind].sum()) for kind in kinds)], pa.int64()
            ),
            "n_distinct": pa.array(
                [*nothing, *(int((shared == kind).sum()) for kind in kinds)], pa.int64()
            ),
        }
    )


def _neighbours(place: np.ndarray, beside: np.ndarray, count: int, classes: int):
    """For each of ``count`` words: how many classes are beside it, which, and how often."""
    keys, n = np.unique(place * np.int64(classes) + beside, return_counts=True)
    word = keys // classes
    sizes = np.bincount(word, minlength=count).astype(np.uint8)
    first = np.searchsorted(word, np.arange(count + 1))
    return first, sizes, (keys % classes).astype(np.uint8), n.astype(np.uint32)


def _told(found, a: int, b: int) -> bytes:
    """What was found beside some words as bytes."""
    first, sizes, classes, n = found
    low, high = first[a], first[b]
    planes = n[low:high].view(np.uint8).reshape(-1, 4).T.tobytes()
    return zlib.compress(sizes[a:b].tobytes() + classes[low:high].tobytes() + planes, 1)


def _asked(frequent: np.ndarray, n_classes: int, buckets: int):
    """Words by bucket, and for those of shared classes what is before and after in training."""

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row)
                classes = block.classes(frequent)
                cuts = _cut(block.vocabulary, buckets)
                of_token = classes[block.tokens]
                at = np.flatnonzero(
                    (of_token >= len(frequent)) & ~block.held_out[block.document]
                )
                before = block.contexts(classes, n_classes)[at, 0]
                # A word is never a text's last token, the end is.
                after = of_token[at + 1]
                columns = []
                for beside in (before, after):
                    found = _neighbours(
                        block.tokens[at].astype(np.int64), beside, len(classes), n_classes + 1
                    )
                    columns.append(pa.array([_told(found, a, b) for _, a, b in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(cuts), pa.int64()),
                        pa.array([bucket for bucket, _, _ in cuts], pa.int32()),
                        _binaries(block.vocabulary[a:b] for _, a, b in cuts),
                        _binaries(classes[a:b].astype(np.uint8) for _, a, b in cuts),
                        *columns,
                    ],
                    _names(_ASKED),
                )

    return run


class Model:
    """Vectors of the classes as context and as prediction, of the distances, and biases."""

    def __init__(self, share: np.ndarray, values: np.ndarray | None = None):
        self.share = share.astype(np.float32)
        n = len(share)
        sizes = [(n + 1) * WIDTH, n * WIDTH, CONTEXT * WIDTH, n]
        if values is None:
            rng = np.random.default_rng(0)
            values = np.concatenate(
                [
                    rng.normal(0, 0.1, sizes[0]),
                    rng.normal(0, 0.1, sizes[1]),
                    np.full(sizes[2], 1 / CONTEXT),
                    np.log(share),
                ]
            )
        self.values = values.astype(np.float32)
        seen, out, scale, self.bias = np.split(self.values, np.cumsum(sizes)[:-1])
        self.seen, self.out = seen.reshape(n + 1, WIDTH), out.reshape(n, WIDTH)
        self.scale = scale.reshape(CONTEXT, WIDTH)

    def log_probabilities(
        self, contexts: np.ndarray, targets: np.ndarray, own=None, before=None, after=None
    ) -> np.ndarray:
        """Natural logarithms, normalised over all classes.

        ``own`` has vectors of words as context, to multiply with the vectors ``after``
        of all classes; ``before`` says which of them is before each target.
        """
        result = np.empty(len(targets))
        nearest_first = [self.seen * scale for scale in self.scale]
        out = self.out if own is None else np.hstack([self.out, after])
        ones = np.ones(len(out), np.float32)
        for at in range(0, len(targets), _SOME):
            some = slice(at, at + _SOME)
            hidden = sum(
                vectors[classes] for vectors, classes in zip(nearest_first, contexts[some].T, strict=True)
            )
            if own is not None:
                hidden = np.hstack([hidden, own[before[some]]])
            scores = hidden @ out.T
            scores += self.bias
            scores -= scores.max(axis=1, keepdims=True)
            chosen = scores[np.arange(len(scores)), targets[some]].astype(float)
            np.exp(scores, out=scores)
            result[some] = chosen - np.log((scores @ ones).astype(float))
        return result


class Trainer:
    """Noise-contrastive estimation with shared noise and Adagrad steps."""

    def __init__(self, model: Model, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.squares = Model(model.share, np.full_like(model.values, 1e-6))
        self.cumulated = np.cumsum(model.share, dtype=float)
        self.log_noise = np.log(NOISE * model.share)

    def _move(self, name: str, gradient: np.ndarray) -> None:
        squares = getattr(self.squares, name)
        squares += gradient * gradient
        getattr(self.model, name)[...] -= RATE * gradient / np.sqrt(squares)

    def step(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        model, n = self.model, len(targets)
        classes = len(model.share)
        noise = np.searchsorted(self.cumulated, self.rng.random(NOISE) * self.cumulated[-1])
        noise = np.minimum(noise, classes - 1)
        vectors = model.seen[contexts]
        hidden = np.einsum("bcw,cw->bw", vectors, model.scale)
        good, bad = model.out[targets], model.out[noise]
        real = np.einsum("bw,bw->b", hidden, good) + (model.bias - self.log_noise)[targets]
        fake = hidden @ bad.T + (model.bias - self.log_noise)[noise]
        # Derivatives of the two-class loss by the scores, averaged over the batch.
        real = -1 / (1 + np.exp(np.clip(real, -30, 30))) / n
        fake = 1 / (1 + np.exp(np.clip(-fake, -30, 30))) / n
        back = real[:, None] * good + fake @ bad
        out, bias = np.zeros_like(model.out), np.zeros_like(model.bias)
        _add_rows(out, targets, real[:, None] * hidden)
        np.add.at(out, noise, fake.T @ hidden)
        bias += np.bincount(targets, real, classes)
        bias += np.bincount(noise, fake.sum(axis=0), classes)
        seen = np.zeros_like(model.seen)
        for place in range(CONTEXT):
            _add_rows(seen, contexts[:, place], back * model.scale[place])
        scale = np.einsum("bcw,bw->cw", vectors, back)
        for name, gradient in (("out", out), ("bias", bias), ("seen", seen), ("scale", scale)):
            self._move(name, gradient)

    def learn(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        order = self.rng.permutation(len(targets))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            self.step(contexts[some], targets[some])


def _add_rows(total: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """``total[places] += rows``, also for places that repeat."""
    order = np.argsort(places, kind="stable")
    first = np.flatnonzero(np.diff(places[order], prepend=-1))
    total[places[order][first]] += np.add.reduceat(rows[order], first, axis=0)


def _trained(share: np.ndarray, values: np.ndarray, frequent: np.ndarray):
    """One row per task: its model times its tokens, its tokens, and how often classes follow."""

    def run(batches):
        number = TaskContext.get().partitionId()
        trainer, n = Trainer(Model(share, values.copy()), seed=number), 0
        follow = np.zeros((len(share) + 1) * len(share), np.int64)
        for batch in batches:
            for row in _rows(batch):
                block = Block(row)
                classes = block.classes(frequent)
                keep = ~block.held_out[block.document]
                contexts = block.contexts(classes, len(share))[keep]
                targets = classes[block.tokens][keep]
                trainer.learn(contexts, targets)
                follow += np.bincount(
                    contexts[:, 0] * np.int64(len(share)) + targets, minlength=len(follow)
                )
                n += int(keep.sum())
        if n:
            total = trainer.model.values.astype(float) * n
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([number % 64], pa.int32()),
                    "total": pa.array([total.tobytes()], pa.binary()),
                    "follow": pa.array([follow.tobytes()], pa.binary()),
                    "n": pa.array([n], pa.int64()),
                }
            )

    return run


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(value, float) for value in frame["total"])
    follow = sum(np.frombuffer(value, np.int64) for value in frame["follow"])
    return pd.DataFrame(
        {
            "part": frame["part"].iloc[:1],
            "total": [total.tobytes()],
            "follow": [follow.tobytes()],
            "n": [frame["n"].sum()],
        }
    )


def _averaged(blocks: DataFrame, share, values, frequent) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' models as one, and how often a class (column) follows another (row)."""
    schema = "part int, total binary, follow binary, n long"
    sums = (
        blocks.mapInArrow(_trained(share, values, frequent), schema)
        .groupBy("part")
        .applyInPandas(_added, schema)
        .collect()  # 64 rows at most
    )
    n = sum(row["n"] for row in sums)
    follow = np.zeros((len(share) + 1, len(share)), np.int64)
    if not n:
        return values, follow
    for row in sums:
        follow += np.frombuffer(row["follow"], np.int64).reshape(follow.shape)
    return (sum(np.frombuffer(row["total"], float) for row in sums) / n).astype(np.float32), follow


def _spread(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The vectors around their mean, turned and scaled to unit variance in every direction."""
    p = (weights + 1) / (weights + 1).sum()
    vectors = vectors.astype(float) - p @ vectors
    sizes, turned = np.linalg.eigh(vectors.T @ (vectors * p[:, None]))
    spread = vectors @ turned / np.sqrt(np.maximum(sizes, 1e-6 * sizes.max() + 1e-12))
    return spread[:, -WORD_WIDTH:].astype(np.float32)


class WordModel:
    """What words of shared classes are trained and weighed with, beside their own vectors."""

    def __init__(self, model: Model, n_frequent: int, follow, shared_n, shared_distinct):
        #: Vectors of the classes before a word (the start is the last) and after it.
        self.before = _spread(model.seen * model.scale[0], follow.sum(axis=1))
        self.after = _spread(model.out, follow.sum(axis=0))
        #: By shared class: counts of the classes before, shares of those after.
        self.n_before = follow[:, n_frequent:].T.astype(float)
        n_after = follow[n_frequent:-1] + model.share
        self.share_after = n_after / n_after.sum(axis=1, keepdims=True)
        #: Sum of the smoothed counts of a shared class and one unseen word.
        self.smoothed = shared_n + shared_distinct + 1.0

        # Of the words that occur once, all with the same neighbour in a class are alike.
        kinds, classes = np.divmod(np.arange(self.n_before.size), self.n_before.shape[1])
        once = np.zeros((len(kinds), len(self.before)))
        once[np.arange(len(kinds)), classes] = 1
        n = np.ones(len(kinds))
        self.once_before = self.as_prediction(n, kinds, once).reshape(*self.n_before.shape, -1)
        kinds, classes = np.divmod(np.arange(self.share_after.size), self.share_after.shape[1])
        once = np.zeros((len(kinds), len(self.after)))
        once[np.arange(len(kinds)), classes] = 1
        self.once_after = self.as_context(n[: len(kinds)], kinds, once).reshape(
            *self.share_after.shape, -1
        )

    def as_prediction(self, n: np.ndarray, kinds: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Vectors of words that occur ``n`` times, from counts of the classes before them."""
        noise = ((n + 1) / self.smoothed[kinds])[:, None] * self.n_before[kinds]
        return _in_bytes(_contrasted(before, NOISE * noise, self.before))

    def as_context(self, n: np.ndarray, kinds: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Vectors of words that occur ``n`` times, from counts of the classes after them."""
        noise = n[:, None] * self.share_after[kinds]
        return _in_bytes(_contrasted(after, NOISE * noise, self.after))


def _contrasted(real: np.ndarray, noise: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Vectors that tell counts of what is real from expected counts of noise, one of each row.

    The odds of a column are the exponential of the product with its vector, by NOISE.
    """
    real, noise = real.astype(np.float32), noise.astype(np.float32)
    both, steepest = real + noise, real / 4
    result = np.zeros((len(real), vectors.shape[1]), np.float32)
    squares = vectors * vectors
    products = result @ vectors.T
    for _ in range(STEPS):
        chance = np.exp(-products)
        chance *= NOISE
        chance += 1
        np.reciprocal(chance, out=chance)
        slope = (real - both * chance) @ vectors - PRIOR * result
        # The logistic curve is at its steepest for what is real, which may be far from fitted.
        curve = chance * (1 - chance)
        curve *= noise
        curve += steepest
        step = slope / (curve @ squares + PRIOR)
        along = step @ vectors.T
        length = (slope * step).sum(axis=1) / np.maximum(
            np.einsum("bc,bc->b", curve, along * along) + PRIOR * (step * step).sum(axis=1), 1e-30
        )
        # No odds change by more than a factor of seven in a step.
        length = np.minimum(length, 2 / np.maximum(np.abs(along).max(axis=1), 1e-30))
        result += length[:, None] * step
        along *= length[:, None]
        products += along
    return result


def _in_bytes(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(vectors * FINE), -127, 127).astype(np.int8)


def _out_of_bytes(vectors: np.ndarray) -> np.ndarray:
    return vectors.astype(np.float32) / FINE


def _parsed(table: pa.Table, name: str, places: np.ndarray, slots: list[int]):
    """Words, the classes beside them and how often, sorted by word."""
    sizes, classes, n = [], [], []
    for value, count in zip(table.column(name).to_pylist(), slots, strict=True):
        data = np.frombuffer(zlib.decompress(value), np.uint8)
        sizes.append(data[:count])
        found = (len(data) - count) // 5
        classes.append(data[count : count + found])
        planes = data[count + found :].reshape(4, found)
        n.append(np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1))
    word = np.repeat(places, np.concatenate(sizes))
    order = np.argsort(word, kind="stable")
    return word[order], np.concatenate(classes)[order].astype(np.int64), np.concatenate(n)[order]


def _dense(found, words: np.ndarray, columns: int) -> np.ndarray:
    """Counts of the classes beside the words (sorted), one row each."""
    word, beside, n = found
    a, b = np.searchsorted(word, [words[0], words[-1] + 1])
    row = np.searchsorted(words, word[a:b])
    inside = words[row] == word[a:b]
    keys = row[inside] * columns + beside[a:b][inside]
    return np.bincount(keys, n[a:b][inside], len(words) * columns).reshape(len(words), columns)


def _answered(words_model: WordModel, n_frequent: int):
    """Counts and vectors of a bucket's words for each block, and the sums of their weights."""

    def run(table: pa.Table) -> pa.Table:
        slots = [len(value) for value in table.column("classes").to_pylist()]
        words, first, places = np.unique(
            _joined(table, "words", np.uint64), return_index=True, return_inverse=True
        )
        classes = _joined(table, "classes", np.uint8)[first]
        kinds = np.maximum(classes.astype(np.int64) - n_frequent, 0)
        before = _parsed(table, "before", places, slots)
        after = _parsed(table, "after", places, slots)
        n = np.bincount(before[0], before[2], len(words)).astype(np.int64)
        as_prediction = np.zeros((len(words), WORD_WIDTH), np.int8)
        as_context = np.zeros((len(words), WORD_WIDTH), np.int8)
        for found, once, vectors in (
            (before, words_model.once_before, as_prediction),
            (after, words_model.once_after, as_context),
        ):
            alone = n[found[0]] == 1
            word = found[0][alone]
            vectors[word] = once[kinds[word], found[1][alone]]
        often = np.flatnonzero(n > 1)
        for at in range(0, len(often), _SOME):
            some = often[at : at + _SOME]
            beside = _dense(before, some, len(words_model.before))
            as_prediction[some] = words_model.as_prediction(n[some], kinds[some], beside)
            beside = _dense(after, some, len(words_model.after))
            as_context[some] = words_model.as_context(n[some], kinds[some], beside)
        weights = np.zeros(words_model.n_before.shape)
        # Words that only held-out documents have keep vectors of zero and no weight.
        known = np.flatnonzero(n)
        for at in range(0, len(known), BATCH):
            some = known[at : at + BATCH]
            weight = np.exp(_out_of_bytes(as_prediction[some]) @ words_model.before.T)
            of_kind = np.zeros((len(weights), len(some)))
            of_kind[kinds[some], np.arange(len(some))] = n[some] + 1
            weights += of_kind @ weight
        answers = np.zeros(len(words), _ANSWER)
        answers["class"], answers["n"] = classes, n
        answers["before"], answers["after"] = as_prediction, as_context
        ends = np.cumsum(slots)
        told = [
            _deflated(answers[places[end - count : end]])
            for end, count in zip(ends.tolist(), slots, strict=True)
        ]
        return pa.table(
            {
                "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
                "bucket": pa.array([table.column("bucket")[0].as_py()] * (len(told) + 1), pa.int32()),
                "answer": pa.array([*told, None], pa.binary()),
                "weights": pa.array([*[None] * len(told), weights.tobytes()], pa.binary()),
            }
        )

    return run


def _of_tokens(block: Block, answers, counts, model: Model, words_model: WordModel, log_weights):
    """Natural logarithm of the probability of every token of a block."""
    start, n_frequent = len(model.share), len(model.share) - SHARED
    classes = answers["class"].astype(np.int16)
    contexts = block.contexts(classes, start)
    of_token = classes[block.tokens]
    as_context = np.zeros((len(classes) + 1, WORD_WIDTH), np.float32)
    as_context[:-1] = _out_of_bytes(answers["after"])
    before = np.full(len(of_token), len(classes), np.int64)
    before[1:] = block.tokens[:-1]
    before[contexts[:, 0] == start] = len(classes)
    score = model.log_probabilities(contexts, of_token, as_context, before, words_model.after)
    as_prediction = np.ascontiguousarray(answers["before"])
    smoothed = np.log(counts + 1.0)
    shared = np.flatnonzero(of_token >= n_frequent)
    for at in range(0, len(shared), BATCH):
        some = shared[at : at + BATCH]
        beside, word = contexts[some, 0], block.tokens[some]
        vectors = _out_of_bytes(as_prediction[word])
        score[some] += np.einsum("tw,tw->t", vectors, words_model.before[beside])
        score[some] += smoothed[word]
        score[some] -= log_weights[of_token[some] - n_frequent, beside]
    return score


def _scored(model: Model, words_model: WordModel, weights, class_n, n_distinct):
    n_all, n_frequent = int(class_n.sum()), len(class_n) - SHARED
    base_sum = np.log10(n_all + n_distinct + 1)
    # One unseen word a class has the weight of a count of zero.
    log_weights = np.log(weights + 1)

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row)
                # Buckets follow one another as the words of the vocabulary do.
                answers = np.concatenate([_inflated(a.as_py(), _ANSWER) for a in row["answers"]])
                counts, own = answers["n"].copy(), answers["class"] < n_frequent
                counts[own] = class_n[answers["class"][own]]
                score = _of_tokens(block, answers, counts, model, words_model, log_weights)
                base = np.log10(counts + 1.0) - base_sum
                first = np.cumsum(block.n_tokens) - block.n_tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"],
                        pa.array(block.held_out),
                        pa.array(block.n_tokens),
                        pa.array(np.add.reduceat((counts > 0)[block.tokens].astype(np.int64), first)),
                        pa.array(np.full(len(first), n_all, np.int64)),
                        pa.array(np.add.reduceat(base[block.tokens], first)),
                        pa.array(np.add.reduceat(score / np.log(10), first)),
                    ],
                    _names(_SCORES),
                )

    return run


def score_texts(
    documents: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_words: int = BUCKET_WORDS
) -> DataFrame:
    """Base and model log10 probability of every document.

    Documents whose crc32 of the id as text leaves 2 when divided by 7 are held out.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held_out = (F.crc32(name.cast("binary")) % 7 == 2).alias("held_out")
    with small_batches(documents.sparkSession):
        blocks = written(
            texts(documents, held_out).mapInArrow(_blocks(block_bytes, SHARED), _BLOCK)
        )
    n_words = blocks.agg(F.sum("n_distinct")).first()[0] or 0
    buckets = max(8, -(-n_words // bucket_words))
    summed = written(
        blocks.mapInArrow(_counted(buckets), _COUNTED)
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInArrow(_summed, _SUMMED)
    )
    end = int(END.view(np.int64))
    top = (
        summed.filter(F.col("word").isNotNull() & (F.col("word") != end))
        .orderBy(F.desc("n"), "word")
        .limit(FREQUENT - 1)
        .collect()
    ) + summed.filter(F.col("word") == end).collect()
    frequent = np.array([*{end, *(row["word"] for row in top)}], np.int64).view(np.uint64)
    frequent = np.sort(frequent)
    class_n = np.zeros(len(frequent) + SHARED, np.int64)
    shared_distinct = np.zeros(SHARED, np.int64)
    for row in summed.filter("word is null").groupBy("shared").agg(
        F.sum("n").alias("n"), F.sum("n_distinct").alias("n_distinct")
    ).collect():
        class_n[len(frequent) + row["shared"]] = row["n"]
        shared_distinct[row["shared"]] = row["n_distinct"]
    n_distinct = int(shared_distinct.sum())
    for row in top:
        class_n[np.searchsorted(frequent, np.int64(row["word"]).view(np.uint64))] = row["n"]
        class_n[len(frequent) + row["shared"]] -= row["n"]
        shared_distinct[row["shared"]] -= 1
    share = (class_n + 1) / (class_n + 1).sum()

    values = Model(share).values
    first = F.expr(f"pmod(xxhash64(block), {_FIRST_SHARE}) = 0")
    follow = 0
    for some in (blocks.filter(first), blocks.filter(~first)):
        values, more = _averaged(some, share, values, frequent)
        follow = follow + more
    model = Model(share, values)
    words_model = WordModel(
        model, len(frequent), follow, class_n[len(frequent) :], shared_distinct
    )

    answered = written(
        blocks.mapInArrow(_asked(frequent, len(share), buckets), _ASKED)
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInArrow(_answered(words_model, len(frequent)), _ANSWERED)
    )
    weights = array_sum(
        answered.filter("block is null"), "weights", np.zeros(words_model.n_before.shape)
    )
    told = F.sort_array(F.collect_list(F.struct("bucket", "answer")))["answer"]
    answers = answered.filter("block is not null").groupBy("block").agg(told.alias("answers"))
    scored = _scored(model, words_model, weights, class_n, n_distinct)
    return (
        blocks.drop("vocabulary", "shared").join(answers, "block").mapInArrow(scored, _SCORES)
    )
