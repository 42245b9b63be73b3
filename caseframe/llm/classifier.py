"""A quality classifier by co-training two views of a document.

The text view sees which words and word endings occur and whether words repeat; the metadata view sees
source, language and length. Both start from labelled documents. In each round
either view labels all unlabelled documents that it is sure about, and the other
one learns from them as well. Each view's score is calibrated on labelled
documents that it did not learn from, and the two are always combined: as views
that are independent for either answer, their log-odds add up, less those of the
answer itself. This is done for low quality and for toxicity; a document that
either finds is rejected.

At most ``LABELLED`` labelled documents, with the smallest hashes of their ids, are
learnt from. The driver has their rows as bits of the chosen features, some tens of
bytes each, whatever their texts are. All other documents take part in every round:
a task adds up what they tell (a gradient and a curvature for each view and label),
and these sums alone are brought together. What a label tells in this way weighs at
most a fifth (``TOLD``) of the labelled documents with it. Features are chosen by counts
that Spark adds up. All documents are scored, over their whole texts.

Nulls: a null text is empty, null metadata are a value of their own, labels that
are null or whose document is missing are not used, and a null id is scored like
any other. Where labels repeat an id the worse one counts. Empty texts have no
words and are judged by their metadata and the bias. Extra columns are ignored.
Without labels of both kinds a question cannot be learnt: nothing is rejected
for it and its score is 0. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.words import NO_LETTER, chunks, mixed, stretch_hashes, words
from caseframe.llm.words import prefix_sums as sums
from caseframe.llm.work import array_sum, texts, written

LABELLED = 12_000
ROUNDS, STEPS = 3, 2
SURE = 0.98
#: What documents labelled by the other view weigh against the labelled ones, at most.
TOLD = 0.2
FEATURES = 256
#: Least chi-square of a feature, far above chance among a million words.
LEAST_CHI = 25.0
#: A document is rejected from this probability on.
REJECT = 0.4
#: Shares of words that repeat the word before them, each a feature.
REPEATS = (0.01, 0.05, 0.2)
META = 256
_LENGTHS = 24

_SCORE = (
    "doc_id long, text_bad double, metadata_bad double, bad_score double,"
    " text_toxic double, metadata_toxic double, toxic_score double, kept boolean"
)

#: Letters become one sign and digits another, so that endings tell junk apart.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[~NO_LETTER] = ord("a")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of the texts in order, and the n + 1 bounds.

    Features are runs of letters, the shape of the last three bytes of a word and
    how many words repeat the one before them.
    """
    letters = words(data, offsets, NO_LETTER)
    plain = words(data, offsets)
    endings = np.maximum(plain.ends - 3, plain.starts)
    shapes = stretch_hashes(sums(_SHAPE[data]), endings, plain.ends) ^ np.uint64(0x5DEECE66D)
    texts_ = np.arange(len(offsets) - 1)
    of_letters, of_plain = (
        np.repeat(texts_, np.diff(found.first)) for found in (letters, plain)
    )
    again = (plain.hashes[1:] == plain.hashes[:-1]) & (of_plain[1:] == of_plain[:-1])
    share = np.bincount(of_plain[1:][again], minlength=len(texts_)) / np.maximum(
        np.diff(plain.first), 1
    )
    repeating = [np.flatnonzero(share >= least) for least in REPEATS]
    marks = [np.full(len(some), turn + 1, np.uint64) for turn, some in enumerate(repeating)]
    hashes = np.concatenate([letters.hashes, shapes, *marks])
    owner = np.concatenate([of_letters, of_plain, *repeating])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(offsets)))


def metadata_places(part: pa.RecordBatch, lengths: np.ndarray) -> np.ndarray:
    """Columns of the metadata view that are set: hashed source and language, the length's scale."""
    places = np.zeros((part.num_rows, 3), np.uint8)
    for turn, name in enumerate(("source", "lang")):
        data, offsets = _strings(part.column(name))
        hashed = mixed(stretch_hashes(sums(data), offsets[:-1], offsets[1:]) + np.uint64(turn))
        places[:, turn] = hashed % np.uint64(META - _LENGTHS)
    scale = np.minimum(np.log2(lengths + 1.0), _LENGTHS - 1).astype(int)
    places[:, 2] = META - _LENGTHS + scale
    return places


def _metadata(places: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(places), META), np.float32)
    at = np.arange(len(places))
    for column in places.T:
        rows[at, column] += 1
    return rows


def metadata_features(part: pa.RecordBatch, lengths: np.ndarray) -> np.ndarray:
    """Columns of the metadata view, set or not."""
    return _metadata(metadata_places(part, lengths))


def _strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = [b"\0" if value is None else value.encode() for value in column.to_pylist()]
    offsets = np.cumsum([0, *map(len, values)])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def _newton_sums(
    x: np.ndarray, weights: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Curvature and gradient of the logistic loss, some rows at a time."""
    curve, gradient = np.zeros((x.shape[1],) * 2), np.zeros(x.shape[1])
    for at in range(0, len(x), 1024):
        rows, own = x[at : at + 1024].astype(float), weight[at : at + 1024]
        p = _probability(rows @ weights)
        gradient += rows.T @ (own * (p - y[at : at + 1024]))
        curve += (rows * (own * p * (1 - p))[:, None]).T @ rows
    return curve, gradient


def logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3
) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression, by Newton's method."""
    x = _with_bias(x)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(15):
        curve, gradient = _newton_sums(x, w, y, weight)
        step = np.linalg.solve(curve + np.diag(penalty), gradient + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def chi_square(present, positive, n, n_positive):
    """How much a feature's presence depends on the label."""
    expected = present * n_positive / n
    return (positive - expected) ** 2 * n / np.maximum(
        expected * (n - n_positive) * (1 - present / n), 1e-9
    )


def best_features(
    values: np.ndarray, present: np.ndarray, positive: np.ndarray, n: int, n_positive: float
) -> np.ndarray:
    """Of features with their counts, the sorted hashes of those that tell most."""
    chi = chi_square(present, positive, n, n_positive)
    # A word that each labelled document has tells nothing.
    chi[(present >= n) | (present < 4)] = 0
    best = np.lexsort((values, -chi))[:FEATURES]
    return np.sort(values[best[chi[best] >= LEAST_CHI]])


def chosen_features(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The features of documents given as lists of hashes that tell most of their labels."""
    hashes = np.concatenate([*docs, np.zeros(0, np.uint64)])
    values, place = np.unique(hashes, return_inverse=True)
    present = np.bincount(place, minlength=len(values)).astype(float)
    positive = np.bincount(place, np.repeat(y, [len(doc) for doc in docs]), len(values))
    return best_features(values, present, positive, len(y), y.sum())


def _presence(docs: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(docs), len(features)), np.float32)
    if len(features):
        for at, doc in enumerate(docs):
            place = np.minimum(np.searchsorted(features, doc), len(features) - 1)
            rows[at, place[features[place] == doc]] = 1
    return rows


def _probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


class View:
    """Linear score of one view and its calibration."""

    def __init__(self):
        self.weights, self.bias, self.slope, self.shift = np.zeros(0), 0.0, 1.0, 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.slope * (x @ self.weights + self.bias) + self.shift


class CoTrained:
    """Both views for one yes-or-no question, and their combination."""

    def __init__(self, features: np.ndarray):
        self.features = features
        self.text, self.meta = View(), View()
        self.mix = np.array([0.0, 0.0, -30.0])  # without a fit: never

    def combined(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return _probability(self.mix[0] * text + self.mix[1] * meta + self.mix[2])


def held_out(y: np.ndarray) -> np.ndarray:
    """Every fourth row of either label: not learnt from, but for calibration."""
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        held[np.flatnonzero(y == label)[3::4]] = True
    return held


def learnable(y: np.ndarray, held: np.ndarray) -> bool:
    return min(y[~held].sum(), (1 - y[~held]).sum(), y[held].sum(), (1 - y[held]).sum()) >= 2


def _with_bias(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x), x.dtype)])


def told_by(x: np.ndarray, weights: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What documents that the other view is sure of tell a view, for either label.

    ``x`` are their columns with a bias, ``other`` the other view's probabilities. A
    label's sums are a square: the curvature, the gradient in the last column, and
    the number of documents in the corner.
    """
    size = x.shape[1]
    sums_ = np.zeros((2, size + 1, size + 1))
    for label in (0, 1):
        sure = (other if label else 1 - other) >= SURE
        rows = x[sure].astype(float)
        p = _probability(rows @ weights)
        sums_[label, :size, :size] = (rows * (p * (1 - p))[:, None]).T @ rows
        sums_[label, :size, size] = rows.T @ (p - label)
        sums_[label, size, size] = sure.sum()
    return sums_


class CoTraining:
    """The state of co-training for one question: weights of both views, bias last."""

    RIDGE = 0.3

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.y, self.held = y, held
        self.views = [_with_bias(text), _with_bias(meta)]
        self.weights = []
        for x in (text, meta):
            weights, bias = logistic(x[~held], y[~held], np.ones((~held).sum()), self.RIDGE)
            self.weights.append(np.append(weights, bias))

    def advance(self, told: list[np.ndarray]) -> None:
        """One Newton step of both views, by the labelled rows and the sums of the others."""
        y = self.y[~self.held]
        for turn, sums_ in enumerate(told):
            weights = self.weights[turn]
            size = len(weights)
            penalty = np.full(size, self.RIDGE)
            penalty[-1] = 1e-3
            curve, gradient = _newton_sums(
                self.views[turn][~self.held], weights, y, np.ones(len(y))
            )
            curve += np.diag(penalty)
            gradient += penalty * weights
            for label in (0, 1):
                count = sums_[label, size, size]
                if count:
                    share = TOLD * min(1.0, (y == label).sum() / count)
                    curve += share * sums_[label, :size, :size]
                    gradient += share * sums_[label, :size, size]
            self.weights[turn] = weights - np.linalg.solve(curve, gradient)

    def finished(self, features: np.ndarray) -> CoTrained:
        """Both views calibrated on the held-out rows, and their log-odds added up."""
        model, held, y = CoTrained(features), self.held, self.y[self.held]
        ones = np.ones(len(y))
        for view, x, weights in zip((model.text, model.meta), self.views, self.weights, strict=True):
            view.weights, view.bias = weights[:-1], float(weights[-1])
            raw = x[held] @ weights
            (slope,), view.shift = logistic(raw[:, None], y, ones, ridge=1e-2)
            view.slope = max(float(slope), 0.0)
        model.mix = np.array([1.0, 1.0, -np.log(y.mean() / (1 - y.mean()))])
        return model


def co_train(
    docs: list[np.ndarray],
    meta: np.ndarray,
    y: np.ndarray,
    more_docs: list[np.ndarray],
    more_meta: np.ndarray,
) -> CoTrained:
    """Co-training on documents that are all at hand: what ``fit`` does over a table."""
    held = held_out(y)
    if not learnable(y, held):
        return CoTrained(np.zeros(0, np.uint64))
    learn = [doc for doc, out in zip(docs, held, strict=True) if not out]
    features = chosen_features(learn, y[~held])
    state = CoTraining(_presence(docs, features), meta, y, held)
    more = [_with_bias(_presence(more_docs, features)), _with_bias(more_meta)]
    for _ in range(ROUNDS):
        sure = [_probability(x @ weights) for x, weights in zip(more, state.weights, strict=True)]
        for _ in range(STEPS):
            state.advance(
                [told_by(more[turn], state.weights[turn], sure[1 - turn]) for turn in (0, 1)]
            )
    return state.finished(features)


def _judged(models: list[CoTrained], batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """Text, metadata and combined score for each question, and which rows stay."""
    columns, all_kept = [[] for _ in range(3 * len(models))], []
    for part, data, offsets in chunks(batch):
        hashes, first = text_features(data, offsets)
        owner = np.repeat(np.arange(part.num_rows), np.diff(first))
        meta = metadata_features(part, np.diff(offsets))
        kept = np.ones(part.num_rows, bool)
        for turn, model in enumerate(models):
            text, other = np.full(part.num_rows, model.text.bias), np.zeros(part.num_rows)
            if len(model.features):
                place = np.searchsorted(model.features, hashes)
                place = np.minimum(place, len(model.features) - 1)
                hit = model.features[place] == hashes
                text += np.bincount(owner[hit], model.text.weights[place[hit]], part.num_rows)
            text = model.text.slope * text + model.text.shift
            if len(model.meta.weights):
                other = model.meta.score(meta)
            both = model.combined(text, other)
            kept &= both < REJECT
            for at, values in enumerate((_probability(text), _probability(other), both)):
                columns[3 * turn + at].append(values)
        all_kept.append(kept)
    joined = [np.concatenate([*values, np.zeros(0)]) for values in columns]
    return joined, np.concatenate([*all_kept, np.zeros(0, bool)])


def _scores(models: list[CoTrained]):
    names = [field.split()[0] for field in _SCORE.split(",")]

    def run(batches):
        for batch in batches:
            columns, kept = _judged(models, batch)
            arrays = [batch.column("doc_id"), *map(pa.array, columns), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _filtered(models: list[CoTrained]):
    def run(batches):
        for batch in batches:
            plain = {name: batch.column(name).cast(pa.string()) for name in ("source", "lang")}
            plain["text"] = batch.column("text").cast(pa.string()).fill_null("")
            _, kept = _judged(models, pa.RecordBatch.from_pydict(plain))
            yield batch.filter(pa.array(kept))

    return run


# Fitting over a table


def _feature_counts(sample: "_Sample"):
    """Counts of features: in how many learnt documents, and in how many with the label."""
    names = ["question", "feature", "present", "positive"]

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                hashes, first = text_features(data, offsets)
                known = sample.place(part.column("doc_id"))
                owner = np.repeat(known, np.diff(first))
                for turn, (y, held) in enumerate(zip(sample.y, sample.held, strict=True)):
                    used = ~held[owner]
                    values, place = np.unique(hashes[used], return_inverse=True)
                    present = np.bincount(place, minlength=len(values))
                    positive = np.bincount(place, y[owner[used]], len(values)).astype(np.int64)
                    columns = [np.full(len(values), turn), values.view(np.int64), present, positive]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


class _Sample:
    """The labelled documents learnt from: sorted ids, and for both questions label and use."""

    def __init__(self, ids: np.ndarray, quality: np.ndarray, toxic: np.ndarray):
        order = np.argsort(ids)
        self.ids = ids[order]
        self.y = [(quality[order] == 0).astype(float), (toxic[order] == 1).astype(float)]
        self.held = [held_out(y) for y in self.y]
        self.usable = [learnable(y, held) for y, held in zip(self.y, self.held, strict=True)]

    def place(self, ids: pa.Array) -> np.ndarray:
        """Places of ids that are all in the sample."""
        return np.searchsorted(self.ids, ids.to_numpy(zero_copy_only=False))

    def has(self, ids: pa.Array) -> np.ndarray:
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return np.isin(known, self.ids) & ids.is_valid().to_numpy(zero_copy_only=False)


def _chosen(counts: DataFrame, sample: _Sample) -> list[np.ndarray]:
    """The features of either question: the chi-squares are taken and ranked in Spark."""
    found = []
    for turn, (y, held) in enumerate(zip(sample.y, sample.held, strict=True)):
        n, n_positive = float((~held).sum()), float(y[~held].sum())
        if not sample.usable[turn]:
            found.append(np.zeros(0, np.uint64))
            continue
        expected = F.col("present") * n_positive / n
        spread = F.greatest(expected * (n - n_positive) * (1 - F.col("present") / n), F.lit(1e-9))
        chi = F.pow(F.col("positive") - expected, F.lit(2)) * n / spread
        rows = (
            counts.filter((F.col("question") == turn) & (F.col("present") >= 4) & (F.col("present") < n))
            .withColumn("chi", chi)
            .filter(F.col("chi") >= LEAST_CHI)
            .orderBy(F.desc("chi"), F.expr("feature ^ (-9223372036854775808L)"))
            .limit(FEATURES)
            .collect()
        )
        found.append(np.sort(np.array([row["feature"] for row in rows], np.int64).view(np.uint64)))
    return found


def _packed(features: list[np.ndarray]):
    """Documents as bits of the chosen features and places of the metadata, 67 bytes each."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                hashes, first = text_features(data, offsets)
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                columns = []
                for chosen in features:
                    bits = np.zeros((part.num_rows, FEATURES), bool)
                    if len(chosen):
                        place = np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)
                        hit = chosen[place] == hashes
                        bits[owner[hit], place[hit]] = True
                    columns.append(np.packbits(bits, axis=1))
                rows = np.concatenate([*columns, metadata_places(part, np.diff(offsets))], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(list(map(bytes, rows)), pa.binary())],
                    ["doc_id", "features"],
                )

    return run


def _unpacked(values: list[bytes], features: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Presence of each question's features, and the metadata columns."""
    width = FEATURES // 8
    rows = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), 2 * width + 3)
    presence = [
        np.unpackbits(rows[:, turn * width : (turn + 1) * width], axis=1)[:, : len(chosen)]
        for turn, chosen in enumerate(features)
    ]
    return [bits.astype(np.float32) for bits in presence], _metadata(rows[:, 2 * width :])


_PACKED = 4096


def _told(sample: _Sample, features: list[np.ndarray], teachers, learners):
    """Sums of what a task's unlabelled documents tell both views of both questions."""

    def run(batches):
        total = None
        for batch in batches:
            free = batch.filter(pa.array(~sample.has(batch.column("doc_id"))))
            for at in range(0, free.num_rows, _PACKED):
                texts_, meta = _unpacked(
                    free.column("features").slice(at, _PACKED).to_pylist(), features
                )
                found = []
                for turn, own in enumerate(learners):
                    views = [_with_bias(texts_[turn]), _with_bias(meta)]
                    sure = [
                        _probability(x @ weights) for x, weights in zip(views, teachers[turn], strict=True)
                    ]
                    for view in (0, 1):
                        sums_ = told_by(views[view], own[view], sure[1 - view])
                        found.append(_in_square(sums_))
                total = np.array(found) if total is None else total + np.array(found)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    return run


def _in_square(sums_: np.ndarray) -> np.ndarray:
    """Sums of a view with few columns, in squares of one size for all."""
    size = sums_.shape[1]
    square = np.zeros((2, FEATURES + 2, FEATURES + 2))
    square[:, :size, :size] = sums_
    return square


def _out_of_square(square: np.ndarray, size: int) -> np.ndarray:
    return square[:, : size + 1, : size + 1]


def _labelled(documents: DataFrame, labels: DataFrame, most: int) -> _Sample:
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("quality").cast("int").alias("quality"),
            F.col("toxic").cast("int").alias("toxic"),
        )
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).dropna()
    found = known.join(ids, "doc_id", "left_semi")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    return _Sample(
        *(np.array([row[name] for row in rows], np.int64) for name in ("doc_id", "quality", "toxic"))
    )


def _fitted(
    documents: DataFrame, labels: DataFrame, labelled: int
) -> tuple[list[CoTrained], list[np.ndarray], DataFrame | None]:
    """The models, their features, and the table of all documents as these."""
    nothing = CoTrained(np.zeros(0, np.uint64))
    sample = _labelled(documents, labels, labelled)
    if not any(sample.usable):
        return [nothing, nothing], [], None
    rows = texts(documents, "source", "lang")
    spark = documents.sparkSession
    # A sample is of bounded size, so it may be broadcast.
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in sample.ids.tolist()], "doc_id long"))
    counts = written(
        rows.join(wanted, "doc_id")
        .mapInArrow(
            _feature_counts(sample), "question long, feature long, present long, positive long"
        )
        .groupBy("question", "feature")
        .agg(F.sum("present").alias("present"), F.sum("positive").alias("positive"))
    )
    features = _chosen(counts, sample)
    packed = written(rows.mapInArrow(_packed(features), "doc_id long, features binary"))
    # An id that repeats is learnt from once.
    own = packed.join(wanted, "doc_id").groupBy("doc_id").agg(F.min("features").alias("features"))
    known = sorted(own.collect())
    presence, meta = _unpacked([bytes(row["features"]) for row in known], features)
    states = [
        CoTraining(presence[turn], meta, sample.y[turn], sample.held[turn])
        if sample.usable[turn]
        else None
        for turn in (0, 1)
    ]
    idle = [np.append(np.zeros(0), 0.0), np.zeros(META + 1)]
    zero = np.zeros((4, 2, FEATURES + 2, FEATURES + 2))

    def weights():
        return [state.weights if state else idle for state in states]

    for _ in range(ROUNDS):
        teachers = weights()
        for _ in range(STEPS):
            run = _told(sample, features, teachers, weights())
            total = array_sum(packed.mapInArrow(run, "sums binary"), "sums", zero)
            for turn, state in enumerate(states):
                if state:
                    state.advance(
                        [
                            _out_of_square(total[2 * turn + view], len(state.weights[view]))
                            for view in (0, 1)
                        ]
                    )
    models = [
        state.finished(features[turn]) if state else nothing for turn, state in enumerate(states)
    ]
    return models, features, packed


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> list[CoTrained]:
    """Models for low quality and for toxicity."""
    return _fitted(documents, labels, labelled)[0]


def _scores_of_packed(models: list[CoTrained], features: list[np.ndarray]):
    names = [field.split()[0] for field in _SCORE.split(",")]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _PACKED):
                part = batch.slice(at, _PACKED)
                texts_, meta = _unpacked(part.column("features").to_pylist(), features)
                columns, kept = [], np.ones(part.num_rows, bool)
                for turn, model in enumerate(models):
                    text, other = np.zeros(part.num_rows), np.zeros(part.num_rows)
                    if len(model.meta.weights):
                        text, other = model.text.score(texts_[turn]), model.meta.score(meta)
                    both = model.combined(text, other)
                    kept &= both < REJECT
                    columns += [_probability(text), _probability(other), both]
                arrays = [part.column("doc_id"), *map(pa.array, columns), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def score_documents(documents: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """Scores of both views and their combination for every row, and ``kept``."""
    models, features, packed = _fitted(documents, labels, **{"labelled": LABELLED, **bounds})
    if packed is None:
        return texts(documents, "source", "lang").mapInArrow(_scores(models), _SCORE)
    return packed.mapInArrow(_scores_of_packed(models, features), _SCORE)


def keep_good(documents: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``documents`` that neither question rejects, all columns as they were."""
    models = fit(documents, labels, **bounds)
    return documents.mapInArrow(_filtered(models), documents.schema)
