"""A bidirectional LSTM over sequences of sparse and dense features, in numpy.

A step's input is the mean vector of its path features, the mean vector of its
word features and its dense features. One LSTM reads the sequence forwards, one
backwards; both states and the input give the probability that the step is wanted. Sequences
of a batch are sorted by length, so that each step multiplies only those that
still run.
"""

from dataclasses import dataclass

import numpy as np

PATHS, WORDS = 1024, 8192
PATH_SIZE, WORD_SIZE, DENSE, HIDDEN = 24, 16, 8, 24
INPUT = PATH_SIZE + WORD_SIZE + DENSE
_ALIKE = 16


@dataclass
class Sequence:
    """Steps of one sequence: flat feature numbers with n + 1 borders each, and dense rows."""

    paths: np.ndarray
    path_ends: np.ndarray
    words: np.ndarray
    word_ends: np.ndarray
    dense: np.ndarray

    def __len__(self) -> int:
        return len(self.dense)


Parameters = dict[str, np.ndarray]


def start(seed: int) -> Parameters:
    rng = np.random.default_rng(seed)

    def scaled(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    found = {
        "paths": rng.normal(0, 0.3, (PATHS, PATH_SIZE)).astype(np.float32),
        "words": rng.normal(0, 0.1, (WORDS, WORD_SIZE)).astype(np.float32),
        "out": scaled(2 * HIDDEN, 1),
        "out_input": np.zeros((INPUT, 1), np.float32),
        "out_bias": np.zeros(1, np.float32),
    }
    for side in ("ahead", "back"):
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        found |= {
            f"{side}_in": scaled(INPUT, 4 * HIDDEN),
            f"{side}_state": scaled(HIDDEN, 4 * HIDDEN),
            f"{side}_bias": bias,
        }
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _means(vectors: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean vector of the features of each step; zero where a step has none."""
    size = np.diff(ends)
    found = np.zeros((len(size), vectors.shape[1]), np.float32)
    some = size > 0
    if some.any():
        found[some] = np.add.reduceat(vectors[flat], ends[:-1][some], axis=0) / size[some, None]
    return found


def _inputs(model: Parameters, sequence: Sequence) -> np.ndarray:
    return np.concatenate(
        [
            _means(model["paths"], sequence.paths, sequence.path_ends),
            _means(model["words"], sequence.words, sequence.word_ends),
            sequence.dense,
        ],
        axis=1,
    )


def _running(lengths: np.ndarray) -> np.ndarray:
    """How many sequences, longest first, have a step at each place."""
    steps = np.arange(lengths[0]) if len(lengths) else np.zeros(0, int)
    return len(lengths) - np.searchsorted(lengths[::-1], steps, side="right")


def _forward(model: Parameters, side: str, x: np.ndarray, running: np.ndarray, keep: bool):
    """States after each step (steps x sequences), and what the way back needs."""
    steps, count, _ = x.shape
    given = x @ model[f"{side}_in"] + model[f"{side}_bias"]
    state = np.zeros((count, HIDDEN), np.float32)
    cell = np.zeros((count, HIDDEN), np.float32)
    states = np.zeros((steps, count, HIDDEN), np.float32)
    kept = []
    for step in range(steps):
        n = running[step]
        gates = given[step, :n] + state[:n] @ model[f"{side}_state"]
        opened = _sigmoid(gates[:, : 3 * HIDDEN])
        enter, stay, leave = np.split(opened, 3, axis=1)
        new = np.tanh(gates[:, 3 * HIDDEN :])
        before = cell[:n].copy()
        cell[:n] = stay * before + enter * new
        shown = np.tanh(cell[:n])
        if keep:
            kept.append((enter, stay, leave, new, before, shown, state[:n].copy()))
        state[:n] = leave * shown
        states[step, :n] = state[:n]
    return states, kept


def _backward(model: Parameters, side: str, x, running, kept, states_slope, slopes) -> np.ndarray:
    """Adds the slopes of the side's parameters; returns those of the input."""
    steps, count, _ = x.shape
    given_slope = np.zeros((steps, count, 4 * HIDDEN), np.float32)
    state_slope = np.zeros((count, HIDDEN), np.float32)
    cell_slope = np.zeros((count, HIDDEN), np.float32)
    weights = model[f"{side}_state"]
    for step in range(steps - 1, -1, -1):
        n = running[step]
        enter, stay, leave, new, before, shown, earlier = kept[step]
        total = states_slope[step, :n] + state_slope[:n]
        inner = cell_slope[:n] + total * leave * (1 - shown**2)
        gates = np.concatenate(
            [
                inner * new * enter * (1 - enter),
                inner * before * stay * (1 - stay),
                total * shown * leave * (1 - leave),
                inner * enter * (1 - new**2),
            ],
            axis=1,
        )
        given_slope[step, :n] = gates
        slopes[f"{side}_state"] += earlier.T @ gates
        state_slope[:n] = gates @ weights.T
        cell_slope[:n] = inner * stay
    flat = given_slope.reshape(-1, 4 * HIDDEN)
    slopes[f"{side}_in"] += x.reshape(-1, INPUT).T @ flat
    slopes[f"{side}_bias"] += flat.sum(axis=0)
    return given_slope @ model[f"{side}_in"].T


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence back to front, in place of its own steps."""
    turned = np.zeros_like(x)
    for at, length in enumerate(lengths.tolist()):
        turned[:length, at] = x[:length, at][::-1]
    return turned


def _batch(model: Parameters, sequences: list[Sequence]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(sequence) for sequence in sequences])
    x = np.zeros((lengths[0], len(sequences), INPUT), np.float32)
    for at, sequence in enumerate(sequences):
        x[: lengths[at], at] = _inputs(model, sequence)
    return x, lengths


def _chance(model: Parameters, both: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _sigmoid(both @ model["out"] + x @ model["out_input"] + model["out_bias"])[:, :, 0]


def scores(model: Parameters, sequences: list[Sequence], steps: int = 1 << 14) -> list[np.ndarray]:
    """Probability of each step of each sequence.

    About ``steps`` steps are held at a time, or one sequence: a longer one is
    still read as a whole.
    """
    order = sorted(range(len(sequences)), key=lambda at: -len(sequences[at]))
    found: list[np.ndarray] = [np.zeros(0, np.float32)] * len(sequences)
    place = 0
    while place < len(order) and len(sequences[order[place]]):
        width = max(1, steps // len(sequences[order[place]]))
        chosen = [at for at in order[place : place + width] if len(sequences[at])]
        place += width
        x, lengths = _batch(model, [sequences[at] for at in chosen])
        running = _running(lengths)
        ahead, _ = _forward(model, "ahead", x, running, False)
        back, _ = _forward(model, "back", _turned(x, lengths), running, False)
        both = np.concatenate([ahead, _turned(back, lengths)], axis=2)
        chance = _chance(model, both, x)
        for column, at in enumerate(chosen):
            found[at] = chance[: lengths[column], column]
    return found


def slopes_of(
    model: Parameters, sequences: list[Sequence], labels: list[np.ndarray]
) -> tuple[float, Parameters]:
    """Mean cross-entropy of the steps and its slope in every parameter."""
    order = sorted(range(len(sequences)), key=lambda at: -len(sequences[at]))
    sequences, labels = [sequences[at] for at in order], [labels[at] for at in order]
    x, lengths = _batch(model, sequences)
    running = _running(lengths)
    turned = _turned(x, lengths)
    ahead, kept_ahead = _forward(model, "ahead", x, running, True)
    back, kept_back = _forward(model, "back", turned, running, True)
    both = np.concatenate([ahead, _turned(back, lengths)], axis=2)
    chance = _chance(model, both, x)
    wanted = np.zeros_like(chance)
    real = np.zeros_like(chance)
    for at, own in enumerate(labels):
        wanted[: len(own), at] = own
        real[: len(own), at] = 1
    total = real.sum()
    sure = np.clip(np.where(wanted > 0, chance, 1 - chance), 1e-7, 1)
    loss = float(-(np.log(sure) * real).sum() / total)
    slope = ((chance - wanted) * real / total)[:, :, None].astype(np.float32)
    slopes = {name: np.zeros_like(value) for name, value in model.items()}
    slopes["out"] += both.reshape(-1, 2 * HIDDEN).T @ slope.reshape(-1, 1)
    slopes["out_input"] += x.reshape(-1, INPUT).T @ slope.reshape(-1, 1)
    slopes["out_bias"] += slope.sum()
    both_slope = slope @ model["out"].T
    x_slope = slope @ model["out_input"].T
    x_slope += _backward(
        model, "ahead", x, running, kept_ahead, both_slope[:, :, :HIDDEN], slopes
    )
    x_slope += _turned(
        _backward(
            model, "back", turned, running, kept_back, _turned(both_slope[:, :, HIDDEN:], lengths), slopes
        ),
        lengths,
    )
    for at, sequence in enumerate(sequences):
        own = x_slope[: lengths[at], at]
        for name, flat, ends, part in (
            ("paths", sequence.paths, sequence.path_ends, own[:, :PATH_SIZE]),
            ("words", sequence.words, sequence.word_ends, own[:, PATH_SIZE : PATH_SIZE + WORD_SIZE]),
        ):
            size = np.diff(ends)
            each = part / np.maximum(size, 1)[:, None]
            np.add.at(slopes[name], flat, np.repeat(each, size, axis=0))
    return loss, slopes


def fit(
    sequences: list[Sequence],
    labels: list[np.ndarray],
    epochs: int = 10,
    batch: int = 16,
    rate: float = 0.01,
    seed: int = 7,
) -> Parameters:
    """Parameters after Adam steps over shuffled batches, the rate falling to nothing.

    A batch holds sequences of about the same length.
    """
    model = start(seed)
    usable = [at for at, sequence in enumerate(sequences) if len(sequence)]
    rng = np.random.default_rng(seed)
    first = {name: np.zeros_like(value) for name, value in model.items()}
    second = {name: np.zeros_like(value) for name, value in model.items()}
    done, steps = 0, epochs * (-(-len(usable) // batch) + 1)
    for _ in range(epochs):
        shuffled = rng.permutation(usable).astype(int).tolist()
        batches = []
        for at in range(0, len(shuffled), _ALIKE * batch):
            alike = sorted(shuffled[at : at + _ALIKE * batch], key=lambda i: len(sequences[i]))
            batches += [alike[i : i + batch] for i in range(0, len(alike), batch)]
        for place in rng.permutation(len(batches)).tolist():
            chosen = batches[place]
            _, slopes = slopes_of(model, [sequences[i] for i in chosen], [labels[i] for i in chosen])
            norm = np.sqrt(sum(float((slope**2).sum()) for slope in slopes.values()))
            shrink = min(1.0, 5 / max(norm, 1e-9))
            now = rate * (1 - done / steps)
            done += 1
            for name, slope in slopes.items():
                slope *= shrink
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.01 * (slope**2 - second[name])
                mean = first[name] / (1 - 0.9**done)
                spread = np.sqrt(second[name] / (1 - 0.99**done)) + 1e-8
                model[name] -= now * mean / spread
    return model
