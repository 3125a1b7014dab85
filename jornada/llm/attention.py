"""A small causal self-attention model of subword ids, in numpy.

One layer with one head: every id has a query, a key, a value, a residual
vector and one for the position after it; a position attends to itself and to
earlier ones in its window, with a learned bias per distance, and a small dense
layer follows. The output is a two-level softmax: a group, and a slot within
the group. Frequent ids have a slot of their own; the others share slots,
within which they have their share of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH, DENSE = 16, 32
#: Positions scored per window, and positions before them that are context alone.
STRIDE = 16
WINDOW = 2 * STRIDE
INPUTS, GROUPS, SLOTS = 4096, 32, 32
#: Windows of a training step: at first, after how many windows one more is taken, and at most. The highest learning rate.
FIRST_BATCH, GROWS_AFTER, BATCH, RATE = 16, 100, 128, 0.02
_FAR = np.float32(-1e9)


@dataclass
class Vocabulary:
    """How ids are seen: `inputs` for the context, `classes` (group * SLOTS + slot) for the output.

    `share` is the log of P(id | class), `weights` how often each class occurs (groups, slots).
    """

    inputs: np.ndarray
    classes: np.ndarray
    share: np.ndarray
    weights: np.ndarray


def vocabulary(counts: np.ndarray, opens: np.ndarray) -> Vocabulary:
    """From the corpus counts of all ids; `opens` marks the ids that open a word.

    Ids that open words and others go to groups of their own, in order of
    frequency. The last slot of each group is shared by rare ids.
    """
    size = len(counts)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    inputs = np.minimum(place, INPUTS - 1)
    known = np.zeros(size, bool)
    known[order[: GROUPS * (SLOTS - 1)]] = True
    frequent = order[: GROUPS * (SLOTS - 1)]
    frequent = frequent[np.argsort(opens[frequent], kind="stable")]
    classes = np.empty(size, np.int64)
    n = np.arange(len(frequent))
    classes[frequent] = n // (SLOTS - 1) * SLOTS + n % (SLOTS - 1)
    groups_of = [np.unique(classes[frequent[opens[frequent] == kind]] // SLOTS) for kind in (0, 1)]
    smoothed = counts + 1.0
    for kind in (0, 1):
        rest = order[~known[order] & (opens[order] == kind)]
        groups = groups_of[kind] if len(groups_of[kind]) else np.arange(GROUPS)
        if len(rest):
            # Bands of equal weight.
            weight = np.cumsum(smoothed[rest])
            band = np.minimum((weight - smoothed[rest]) * len(groups) / weight[-1], len(groups) - 1).astype(np.int64)
            classes[rest] = groups[band] * SLOTS + SLOTS - 1
    total = np.bincount(classes, weights=smoothed, minlength=GROUPS * SLOTS)
    share = np.log(smoothed / total[classes])
    weights = np.bincount(classes, weights=counts, minlength=GROUPS * SLOTS).reshape(GROUPS, SLOTS)
    return Vocabulary(inputs.astype(np.int32), classes.astype(np.int32), share, weights)


@dataclass
class Attention:
    """`table` has query, key, value, residual and next residual of each input, and of the padding after them.

    `groups`, `slots` and `dense` are weights whose last row is the offset.
    """

    table: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    back: np.ndarray
    groups: np.ndarray
    slots: np.ndarray

    @staticmethod
    def new(seed: int = 3) -> Attention:
        random = np.random.default_rng(seed)
        table = random.normal(0, 0.1, (INPUTS + 1, 5 * WIDTH)).astype(np.float32)
        groups = random.normal(0, 0.1, (WIDTH + 1, GROUPS)).astype(np.float32)
        slots = random.normal(0, 0.1, (GROUPS, WIDTH + 1, SLOTS)).astype(np.float32)
        # Near positions count more from the start.
        bias = (-0.2 * np.arange(WINDOW)).astype(np.float32)
        dense = random.normal(0, 0.2, (WIDTH + 1, DENSE)).astype(np.float32)
        back = random.normal(0, 0.1, (DENSE, WIDTH)).astype(np.float32)
        table[INPUTS] = 0
        return Attention(table, bias, dense, back, groups, slots)

    @staticmethod
    def at_frequencies(words: Vocabulary, seed: int = 3) -> Attention:
        """A new model that begins at the classes' shares of the corpus, so that it need not learn them."""
        model = Attention.new(seed)
        weights = words.weights + 0.5
        of_group = weights.sum(1)
        model.groups[-1] = np.log(of_group / of_group.sum())
        model.slots[:, -1] = np.log(weights / of_group[:, None])
        return model


def _distances(queries: int, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each key before each query (queries end where keys end), and what masks later keys."""
    far = np.arange(queries)[:, None] + keys - queries - np.arange(keys)[None, :]
    return np.maximum(far, 0), np.where(far < 0, _FAR, np.float32(0))


def _attend(model: Attention, seen: np.ndarray):
    """Everything up to the dense layer, for all positions of each window; padding may only follow a text.

    Products are held below 40, far above any that training reaches, instead of
    being shifted by their largest.
    """
    n = seen.shape[1]
    query, key, value, residual, after = np.split(model.table.take(seen, axis=0), 5, axis=-1)
    far, mask = _distances(n, n)
    weights = np.matmul(query * np.float32(WIDTH**-0.5), key.transpose(0, 2, 1))
    np.minimum(weights, 40, out=weights)
    np.exp(weights, out=weights)
    weights *= np.where(mask == 0, np.exp(model.bias[far]), 0).astype(np.float32)
    weights /= (weights.reshape(-1, n) @ np.ones(n, np.float32)).reshape(*seen.shape, 1)
    mixed = np.matmul(weights, value)
    hidden = residual + mixed
    hidden[:, 1:] += after[:, :-1]
    return query, key, value, weights, mixed, hidden


def _with_one(hidden: np.ndarray) -> np.ndarray:
    flat = np.ones((hidden.size // WIDTH, WIDTH + 1), np.float32)
    flat[:, :WIDTH] = hidden.reshape(-1, WIDTH)
    return flat


def _softmax(logits: np.ndarray) -> np.ndarray:
    np.minimum(logits, 40, out=logits)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], np.float32))[:, None]
    return logits


def _by_group(groups: np.ndarray):
    """Positions in the order of their groups, and the slice of each group that occurs."""
    many = np.bincount(groups, minlength=GROUPS)
    ends = np.cumsum(many)
    slices = [(g, slice(ends[g] - many[g], ends[g])) for g in np.flatnonzero(many)]
    return np.argsort(groups.astype(np.uint8), kind="stable"), slices


class Scorer:
    """The model laid out for scoring: a window needs no reductions but matrix products.

    Values carry a column of ones that sums the weights; padding has zeros
    there and so weighs nothing. Logits are held below 40, far above any that
    training reaches, instead of being shifted by their largest.
    """

    def __init__(self, model: Attention):
        query, key, value, residual, after = np.split(model.table, 5, axis=1)
        self.residual, self.after = np.ascontiguousarray(residual), np.ascontiguousarray(after)
        self.query = query * np.float32(WIDTH**-0.5)
        # Key, value and the column of ones in one row.
        self.given = np.concatenate([key, value, np.ones((len(value), 1), np.float32)], 1)
        self.given[INPUTS, WIDTH:] = 0
        far, mask = _distances(STRIDE, WINDOW)
        self.near = np.where(mask == 0, np.exp(model.bias[far]), 0).astype(np.float32)
        self.groups, self.slots, self.dense, self.back = model.groups, model.slots, model.dense, model.back
        self.ones = np.ones(max(GROUPS, SLOTS), np.float32)

    def _chosen(self, logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        np.minimum(logits, 40, out=logits)
        np.exp(logits, out=logits)
        return logits[np.arange(len(logits)), wanted] / (logits @ self.ones[: logits.shape[1]])

    def log_probability(self, seen: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Natural log of the class probability of what follows each of the last positions of each window.

        `seen` (windows, WINDOW) has inputs with INPUTS as padding, `wanted`
        (windows, STRIDE) the classes that follow.
        """
        last = seen[:, STRIDE:]
        given = self.given.take(seen, axis=0)
        weights = np.matmul(self.query.take(last, axis=0), given[:, :, :WIDTH].transpose(0, 2, 1))
        np.minimum(weights, 40, out=weights)
        np.exp(weights, out=weights)
        weights *= self.near
        summed = np.matmul(weights, given[:, :, WIDTH:]).reshape(-1, WIDTH + 1)
        flat = np.ones((last.size, WIDTH + 1), np.float32)
        np.divide(summed[:, :WIDTH], np.maximum(summed[:, WIDTH:], np.float32(1e-30)), out=flat[:, :WIDTH])
        flat[:, :WIDTH] += self.residual.take(last.ravel(), axis=0)
        flat[:, :WIDTH] += self.after.take(seen[:, STRIDE - 1 : -1].ravel(), axis=0)
        inner = flat @ self.dense
        np.maximum(inner, 0, out=inner)
        flat[:, :WIDTH] += inner @ self.back
        group, slot = np.divmod(wanted.ravel(), SLOTS)
        found = self._chosen(flat @ self.groups, group)
        order, slices = _by_group(group)
        ordered, logits = flat.take(order, axis=0), np.empty((len(flat), SLOTS), np.float32)
        for g, at in slices:
            np.matmul(ordered[at], self.slots[g], out=logits[at])
        found[order] *= self._chosen(logits, slot.take(order))
        return np.log(np.maximum(found, np.float32(1e-37))).reshape(wanted.shape)


def _gradients(model: Attention, seen: np.ndarray, wanted: np.ndarray, counted: np.ndarray):
    """The inputs that occur, and the slopes of their rows of the table and of all other weights."""
    n = seen.shape[1]
    query, key, value, weights, mixed, hidden = _attend(model, seen)
    before = _with_one(hidden)
    inner = np.maximum(before @ model.dense, 0)
    flat = before.copy()
    flat[:, :WIDTH] += inner @ model.back
    group, slot = np.divmod(wanted.ravel(), SLOTS)
    part = (counted.ravel() / max(1, counted.sum())).astype(np.float32)[:, None]
    every = np.arange(len(flat))
    wrong = _softmax(flat @ model.groups)
    wrong[every, group] -= 1
    wrong *= part
    d_groups, d_flat = flat.T @ wrong, wrong @ model.groups.T
    order, own = _by_group(group)
    ordered, wrong = flat.take(order, axis=0), np.empty((len(flat), SLOTS), np.float32)
    for g, at in own:
        np.matmul(ordered[at], model.slots[g], out=wrong[at])
    _softmax(wrong)
    wrong[every, slot.take(order)] -= 1
    wrong *= part.take(order, axis=0)
    d_slots, d_ordered = np.zeros_like(model.slots), np.empty_like(flat)
    for g, at in own:
        np.matmul(ordered[at].T, wrong[at], out=d_slots[g])
        np.matmul(wrong[at], model.slots[g].T, out=d_ordered[at])
    back = np.empty_like(order)
    back[order] = every
    d_flat += d_ordered.take(back, axis=0)
    d_flat = d_flat[:, :WIDTH]
    d_back = inner.T @ d_flat
    d_inner = d_flat @ model.back.T
    d_inner *= inner > 0
    d_dense = before.T @ d_inner
    d_hidden = (d_flat + d_inner @ model.dense[:WIDTH].T).reshape(hidden.shape)
    d_scores = np.matmul(d_hidden, value.transpose(0, 2, 1))
    d_scores -= np.einsum("bij,bij->bi", d_hidden, mixed)[:, :, None]
    d_scores *= weights
    far, _ = _distances(n, n)
    d_bias = np.bincount(far.ravel(), d_scores.sum(0).ravel(), len(model.bias)).astype(np.float32)
    d_rows = np.zeros((*seen.shape, 5 * WIDTH), np.float32)
    d_query, d_key, d_value, d_residual, d_after = np.split(d_rows, 5, axis=-1)
    np.multiply(np.matmul(d_scores, key), np.float32(WIDTH**-0.5), out=d_query)
    np.multiply(np.matmul(d_scores.transpose(0, 2, 1), query), np.float32(WIDTH**-0.5), out=d_key)
    d_value[:] = np.matmul(weights.transpose(0, 2, 1), d_hidden)
    d_residual[:] = d_hidden
    d_after[:, :-1] = d_hidden[:, 1:]
    order = np.argsort(seen.ravel().astype(np.uint16), kind="stable")
    which, first = np.unique(seen.ravel()[order], return_index=True)
    d_table = np.add.reduceat(d_rows.reshape(-1, 5 * WIDTH).take(order, axis=0), first, axis=0)
    d_table[which == INPUTS] = 0
    return which, (d_table, d_bias, d_dense, d_back, d_groups, d_slots)


def batch_after(learned: float) -> int:
    """Windows of the next step: few while the model is rough, more as it has learned from more."""
    return int(min(BATCH, max(FIRST_BATCH, learned // GROWS_AFTER)))


class Trainer:
    """Adam on batches of windows (n, WINDOW + 1) of ids, -1 after a document's end.

    Of the table only the rows of inputs that occur are touched.
    """

    def __init__(self, model: Attention, words: Vocabulary):
        self.model, self.words, self.steps = model, words, 0
        self.parts = parts_of(model)
        self.first, self.second = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        #: How often each input, each group and any position was learned from.
        self.inputs, self.groups, self.positions = np.zeros(INPUTS + 1), np.zeros(GROUPS), 0.0

    def step(self, windows: np.ndarray, rate: float) -> None:
        inputs = np.where(windows < 0, INPUTS, self.words.inputs[windows])[:, :-1]
        classes = np.where(windows < 0, 0, self.words.classes[windows])[:, 1:]
        counted = windows[:, 1:] >= 0
        which, slopes = _gradients(self.model, inputs, classes, counted)
        self.inputs += np.bincount(inputs[counted], minlength=INPUTS + 1)
        self.groups += np.bincount(classes[counted] // SLOTS, minlength=GROUPS)
        self.positions += counted.sum()
        self.steps += 1
        speed = rate * min(1.0, self.steps / 10) / (1 - 0.9**self.steps)
        unbiased = np.float32((1 - 0.98**self.steps) ** -0.5)
        for i, (part, slope, m, v) in enumerate(zip(self.parts, slopes, self.first, self.second)):
            rows = which if i == 0 else slice(None)
            mean, square = m[rows], v[rows]
            mean *= 0.9
            mean += np.float32(0.1) * slope
            square *= 0.98
            square += np.float32(0.02) * slope * slope
            if i == 0:
                m[rows], v[rows] = mean, square
            change = np.sqrt(square)
            change *= unbiased
            change += 1e-8
            np.divide(mean, change, out=change)
            change *= np.float32(speed)
            part[rows] -= change

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """All weights in one row, and how often each was learned from."""
        counts = [np.full(p.shape, self.positions) for p in self.parts]
        counts[0][:] = self.inputs[:, None]
        counts[5][:] = self.groups[:, None, None]
        return flat_of(self.model), np.concatenate([c.ravel() for c in counts]).astype(np.float32)


def parts_of(model: Attention) -> tuple[np.ndarray, ...]:
    return model.table, model.bias, model.dense, model.back, model.groups, model.slots


def flat_of(model: Attention) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts_of(model)])


def from_flat(flat: np.ndarray) -> Attention:
    parts = parts_of(Attention.new())
    cut = np.split(flat.astype(np.float32), np.cumsum([p.size for p in parts])[:-1])
    return Attention(*(c.reshape(p.shape).copy() for c, p in zip(cut, parts)))


def train(
    words: Vocabulary, windows: np.ndarray, steps: int = 2500, batch: int = BATCH, rate: float = RATE, seed: int = 4
) -> Attention:
    """Fits the model to windows in one process, with Adam and a falling rate.

    Few windows are seen four times each, for more would learn them by heart.
    """
    model = Attention.at_frequencies(words)
    if not len(windows):
        return model
    steps = min(steps, max(100, 4 * len(windows) // batch))
    random = np.random.default_rng(seed)
    trainer = Trainer(model, words)
    for step in range(steps):
        trainer.step(windows[random.integers(len(windows), size=batch)], rate * (1 - step / steps) ** 0.5)
    return model


def windows_of(ids: np.ndarray) -> np.ndarray:
    """The windows that learn each of a text's ids once: the first id of each is context alone."""
    n = -(-(len(ids) - 1) // WINDOW)
    held = np.full(n * WINDOW + 1, -1, np.int32)
    held[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(held, WINDOW + 1)[::WINDOW] if n else np.empty((0, WINDOW + 1), np.int32)


def score(model: Scorer, words: Vocabulary, texts: list[np.ndarray], start: int, at_once: int = 512) -> np.ndarray:
    """Log10 probability of each text, given as ids that end with the end id; `start` is the id before its first.

    The texts lie end to end, each after a window's length of padding and
    filled up to whole strides. Overlapping windows run over all of it; each
    scores the last STRIDE positions, so every id is scored once.
    """
    blocks = np.array([-(-len(t) // STRIDE) for t in texts], np.int64)
    # One block of padding before each text.
    begins = np.concatenate([[0], np.cumsum(blocks + 1)])
    seen = np.full(begins[-1] * STRIDE, INPUTS, np.int32)
    wanted = np.zeros(begins[-1] * STRIDE, np.int32)
    share = np.zeros(begins[-1] * STRIDE)
    counted = np.zeros(begins[-1] * STRIDE, bool)
    for text, begin in zip(texts, begins):
        at = (begin + 1) * STRIDE
        seen[at] = words.inputs[start]
        seen[at + 1 : at + len(text)] = words.inputs[text[:-1]]
        wanted[at : at + len(text)] = words.classes[text]
        share[at : at + len(text)] = words.share[text]
        counted[at : at + len(text)] = True
    scored = np.ones(begins[-1], bool)
    scored[begins[:-1]] = False
    chosen = np.flatnonzero(scored)
    total = np.zeros(begins[-1])
    by_block, targets = seen.reshape(-1, STRIDE), wanted.reshape(-1, STRIDE)
    share, counted = share.reshape(-1, STRIDE), counted.reshape(-1, STRIDE)
    for i in range(0, len(chosen), at_once):
        own = chosen[i : i + at_once]
        window = np.concatenate([by_block[own - 1], by_block[own]], 1)
        found = model.log_probability(window, targets[own]) + share[own]
        total[own] = np.where(counted[own], found, 0).sum(1)
    return np.add.reduceat(total, begins[:-1]) / np.log(10) if len(texts) else np.zeros(0)
