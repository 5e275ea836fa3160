"""A small causal self-attention model over subword ids, in numpy: forward, training and batched scoring.

Positions are laid out document by document in blocks of ``STRIDE``. The window of a block is the block
before it, as context, and the block itself; so windows overlap by half and every token is scored once.
A mask hides later positions and the block of another document. The output is factored: the model
predicts a group of classes, then the class in that group, and a token's share of its class comes from counts
of the training texts, after the token before it. Groups of tokens that begin a word come first, so the chance
that a word ends is the mass of those, and the classes of no other group than the target's are looked at.
"""

from __future__ import annotations

import numpy as np

STRIDE = 16
WIDTH, HIDDEN = 16, 24
GROUPS, INNER = 16, 8
CLASSES = GROUPS * INNER
#: weight of a token's overall share against its count after the token before it
PRIOR = 2.0


class Vocabulary:
    """Class of each token and shares of the class; the first ``starts`` classes hold the tokens that begin a word.

    ``ids`` are the training tokens and ``before`` the token before each, the vocabulary's size at the start of a text.
    """

    def __init__(self, ids: np.ndarray, before: np.ndarray, begins_word: np.ndarray, classes: int = CLASSES):
        self._divide(np.bincount(ids, minlength=len(begins_word)), begins_word, classes)
        self.key, self.count = np.unique(self.keys(before, ids), return_counts=True)

    @classmethod
    def of_counts(cls, counts: np.ndarray, begins_word: np.ndarray, classes: int = CLASSES) -> Vocabulary:
        """From the count of each token; what stands after which token is counted elsewhere, see :meth:`keys`."""
        made = cls.__new__(cls)
        made._divide(counts, begins_word, classes)
        made.key = made.count = np.zeros(0, np.int64)
        return made

    def _divide(self, counts: np.ndarray, begins_word: np.ndarray, classes: int) -> None:
        self.starts, self.classes = classes // 2, classes
        self.klass = np.zeros(len(begins_word), np.int64)
        weight = counts + 1.0
        for begin, low in ((True, 0), (False, self.starts)):
            own = np.flatnonzero(begins_word == begin)
            own = own[np.lexsort((own, -counts[own]))]
            mass = np.cumsum(weight[own]) - weight[own] / 2
            self.klass[own] = low + np.minimum((mass / weight[own].sum() * self.starts).astype(np.int64), self.starts - 1)
        self.share = weight / np.bincount(self.klass, weight, classes)[self.klass]

    def keys(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A number for each pair of tokens; pairs of one token and one class after it are neighbours."""
        return (before * self.classes + self.klass[ids]) * len(self.klass) + ids

    def contexts(self, keys: np.ndarray) -> np.ndarray:
        """The token and the class after it that a pair belongs to."""
        return keys // len(self.klass)

    def shares(self, before: np.ndarray, ids: np.ndarray, pair: np.ndarray | None = None, seen: np.ndarray | None = None) -> np.ndarray:
        """ln of each token's share of its class after the token before it.

        ``pair`` is how often the two stand together and ``seen`` how often the class stands there; own counts if not given.
        """
        if pair is None:
            keys = self.keys(before, ids)
            sums = np.append(0, np.cumsum(self.count))
            pair = sums[np.searchsorted(self.key, keys, "right")] - sums[np.searchsorted(self.key, keys)]
            own, asked = self.contexts(self.key), self.contexts(keys)
            seen = sums[np.searchsorted(own, asked, "right")] - sums[np.searchsorted(own, asked)]
        return np.log((pair + PRIOR * self.share[ids]) / (seen + PRIOR))


_SHAPES = {
    "embed": None, "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "bias": (2 * STRIDE,),
    "mix": (WIDTH, HIDDEN), "skip": (WIDTH, HIDDEN), "mix_bias": (HIDDEN,), "out": (HIDDEN, GROUPS), "out_bias": (GROUPS,),
    "inner": (GROUPS, HIDDEN, INNER), "inner_bias": (GROUPS, INNER),
}

# place of each key of the window behind each query of the block, and which are visible
_BEHIND = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]
_VISIBLE, _PLACE = _BEHIND >= 0, np.maximum(_BEHIND, 0)
_HIDDEN = np.float32(-1e9)
_MOST = np.float32(60)
#: positions of one group that are multiplied at once
_TILE = 64


def _lowered(scores: np.ndarray) -> np.ndarray:
    """Scores (choices, n) whose exp neither is infinite nor vanishes; they rarely are so far from 0 that the largest must be subtracted."""
    if scores.size and (scores.max() > _MOST or scores.min() < -_MOST):
        scores -= scores.max(axis=0)
    return scores


def _softmax(scores: np.ndarray, targets: np.ndarray, real: np.ndarray, count: int, with_loss: bool) -> tuple[np.ndarray, float]:
    """The gradient of the mean loss by scores (choices, n), in their place, and the loss if asked for."""
    np.exp(_lowered(scores), out=scores)
    total = scores.sum(axis=0)
    cells, at = scores.reshape(-1), targets * scores.shape[1] + np.arange(scores.shape[1])
    loss = -np.log(np.maximum(cells[at] / total, 1e-30))[real].sum() / count if with_loss else 0.0
    part = (real / count).astype(scores.dtype)
    scores *= part / total
    cells[at] -= part
    return scores, loss


def _ln_chance(scores: np.ndarray, targets: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln chance of the targets among scores (choices, n), and the ln chance of every row of ``sums``, which marks choices; the first row all."""
    n = scores.shape[1]
    picked = _lowered(scores).reshape(-1).take(targets * n + np.arange(n))
    total = np.log(np.maximum(sums @ np.exp(scores, out=scores), 1e-30))
    return picked - total[0], total[1:] - total[0]


class Model:
    """Weights and the passes over a batch of windows."""

    def __init__(self, tokens: int, seed: int = 0):
        make = np.random.default_rng(seed)
        self.weights = {}
        for name, shape in _SHAPES.items():
            shape = shape or (tokens + 1, WIDTH)  # one more for the start of a document
            scale = 0.0 if name.endswith("bias") else 0.3 if name == "embed" else 1 / np.sqrt(shape[-2])
            self.weights[name] = (make.standard_normal(shape) * scale).astype(np.float32)

    def _chances(self, query, key, first):
        """exp of the scores of queries that are scaled already, and their sums; keys are columns."""
        score = query @ key
        score += np.where(_VISIBLE, self.weights["bias"][_PLACE], _HIDDEN)
        score[first, :, :STRIDE] = _HIDDEN
        # nothing near this is ever learned; it takes the place of subtracting the largest score of a row
        if score.size and score.max() > _MOST:
            np.minimum(score, _MOST, out=score)
        np.exp(score, out=score)
        return score, (score.reshape(-1, score.shape[-1]) @ np.ones(score.shape[-1], score.dtype)).reshape(score.shape[:-1])

    def hidden(self, inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The last layer at the positions of consecutive blocks (n, STRIDE); block 0 is context of block 1, and so on."""
        w, n = self.weights, len(inputs)
        x = w["embed"].take(np.append(inputs[:1], inputs), axis=0).reshape(-1, WIDTH)  # what stands before block 0 is hidden from it
        made = (x @ np.concatenate([w["query"] * np.float32(1 / np.sqrt(WIDTH)), w["value"]], axis=1)).reshape(n + 1, STRIDE, 2 * WIDTH)
        turned = w["key"].T @ x.T
        # windows are parts of the same rows, and of the same columns of the keys
        row, cell = made.strides[1:]
        value = np.lib.stride_tricks.as_strided(made[:, :, WIDTH:], (n, 2 * STRIDE, WIDTH), (STRIDE * row, row, cell), writeable=False)
        row, cell = turned.strides
        key = np.lib.stride_tricks.as_strided(turned, (n, WIDTH, 2 * STRIDE), (STRIDE * cell, row, cell), writeable=False)
        chance, total = self._chances(made[1:, :, :WIDTH], key, np.append(True, first[1:]))
        # what was seen, the position itself, and the one of the bias: the inputs of the layer
        inside = np.empty((n * STRIDE, 2 * WIDTH + 1), x.dtype)
        np.divide((chance @ value).reshape(-1, WIDTH), total.reshape(-1, 1), out=inside[:, :WIDTH])
        inside[:, WIDTH : 2 * WIDTH], inside[:, 2 * WIDTH] = x[STRIDE:], 1
        hidden = inside @ np.concatenate([w["mix"], w["skip"], w["mix_bias"][None]])
        return np.maximum(hidden, 0, out=hidden)

    def _grouped(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the order of the targets' groups, and where each group begins among them."""
        group = (targets // INNER).astype(np.int8)
        return np.argsort(group, kind="stable"), np.append(0, np.cumsum(np.bincount(group, minlength=GROUPS)))

    def within(self, hidden: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """ln chance of each target class within its group, multiplied in tiles of one group; what fills a tile is position 0 again."""
        order, cut = self._grouped(targets)
        tiles = -(-np.diff(cut) // _TILE)
        group = np.repeat(np.arange(GROUPS), tiles)
        place = np.empty_like(order)
        place[order] = np.arange(len(order)) + np.repeat((np.cumsum(tiles) - tiles) * _TILE - cut[:-1], np.diff(cut))
        at = np.zeros(len(group) * _TILE, np.int64)
        at[place] = np.arange(len(order))
        scores = hidden.take(at, axis=0).reshape(len(group), _TILE, HIDDEN) @ self.weights["inner"][group]
        scores += self.weights["inner_bias"][group][:, None]
        scores = np.ascontiguousarray(scores.reshape(-1, INNER).T)
        return _ln_chance(scores, targets.take(at) % INNER, np.ones((1, INNER), scores.dtype))[0].take(place)

    def gradients(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray, real: np.ndarray, with_loss: bool = True):
        """Loss per token, and its gradients, for windows (n, 2 * STRIDE) whose second half is predicted.

        Weights that meet the same rows are multiplied at once, and chances stay unscaled: their sums go into narrow factors.
        """
        w, n = self.weights, len(inputs)
        scale = w["embed"].dtype.type(1 / np.sqrt(WIDTH))
        x = w["embed"].take(inputs.reshape(-1), axis=0)
        windows = x.reshape(n, 2 * STRIDE, WIDTH)
        # what was seen, the position itself, and the one of the bias: the inputs of the layer
        inside = np.ones((n * STRIDE, 2 * WIDTH + 1), x.dtype)
        seen, own = inside[:, :WIDTH], inside[:, WIDTH : 2 * WIDTH]
        own.reshape(n, STRIDE, WIDTH)[:] = windows[:, STRIDE:]
        to_window = np.concatenate([w["key"], w["value"]], axis=1)
        query = (own @ (w["query"] * scale)).reshape(n, STRIDE, WIDTH)
        made = (x @ to_window).reshape(n, 2 * STRIDE, 2 * WIDTH)
        key, value = made[:, :, :WIDTH], made[:, :, WIDTH:]
        chance, total = self._chances(query, key.transpose(0, 2, 1), first)
        total = total.reshape(-1, 1)
        np.divide((chance @ value).reshape(-1, WIDTH), total, out=seen)
        hidden = inside @ np.concatenate([w["mix"], w["skip"], w["mix_bias"][None]])
        np.maximum(hidden, 0, out=hidden)

        at, weight_of = targets.reshape(-1), real.reshape(-1)
        count = max(int(weight_of.sum()), 1)
        scores = w["out"].T @ hidden.T
        scores += w["out_bias"][:, None]
        back, loss = _softmax(scores, at // INNER, weight_of, count, with_loss)
        g = {"out": (back @ hidden).T, "out_bias": back.sum(1), "inner": np.zeros_like(w["inner"]), "inner_bias": np.zeros_like(w["inner_bias"])}
        hidden_back = back.T @ w["out"].T
        # positions in the order of their targets' groups, so that a group is a stretch
        order, cut = self._grouped(at)
        groups = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if a < b]
        sorted_ = hidden.take(order, axis=0)
        scores = np.empty((len(order), INNER), x.dtype)
        for k, part in groups:
            np.matmul(sorted_[part], w["inner"][k], out=scores[part])
        scores += np.repeat(w["inner_bias"], np.diff(cut), axis=0)
        back, more = _softmax(np.ascontiguousarray(scores.T), at[order] % INNER, weight_of[order], count, with_loss)
        g["inner_bias"][[k for k, _ in groups]] = np.add.reduceat(back, [part.start for _, part in groups], axis=1).T
        inner_back = np.empty_like(sorted_)
        for k, part in groups:
            mine = back[:, part].T
            np.matmul(sorted_[part].T, mine, out=g["inner"][k])
            np.matmul(mine, w["inner"][k].T, out=inner_back[part])
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        hidden_back += inner_back.take(place, axis=0)
        hidden_back *= hidden > 0

        layer = _product(inside, hidden_back)
        g["mix"], g["skip"], g["mix_bias"] = layer[:WIDTH], layer[WIDTH : 2 * WIDTH], layer[2 * WIDTH]
        # the mean of a row's changes is one product of what was seen, and so needs no pass over the window
        seen_back = hidden_back @ w["mix"].T
        seen_back /= total
        mean = np.einsum("ij,ij->i", seen_back, seen)
        seen_back = seen_back.reshape(n, STRIDE, WIDTH)
        window_back = np.empty_like(made)
        np.matmul(chance.transpose(0, 2, 1), seen_back, out=window_back[:, :, WIDTH:])
        score_back = seen_back @ value.transpose(0, 2, 1)
        score_back -= mean.reshape(n, STRIDE, 1)
        score_back *= chance
        g["bias"] = np.bincount(_PLACE.ravel(), (score_back.sum(0) * _VISIBLE).ravel(), 2 * STRIDE).astype(x.dtype)
        np.matmul(score_back.transpose(0, 2, 1), query, out=window_back[:, :, :WIDTH])
        own_back = np.empty((n * STRIDE, WIDTH + HIDDEN), x.dtype)
        query_back = own_back[:, :WIDTH]
        np.matmul(score_back, key, out=query_back.reshape(n, STRIDE, WIDTH))
        own_back[:, WIDTH:] = hidden_back
        window_back = window_back.reshape(-1, 2 * WIDTH)
        g["query"], of_window = _product(own, query_back) * scale, _product(x, window_back)
        g["key"], g["value"] = of_window[:, :WIDTH], of_window[:, WIDTH:]
        x_back = window_back @ to_window.T
        own_back = own_back @ np.concatenate([w["query"] * scale, w["skip"]], axis=1).T
        x_back.reshape(n, 2 * STRIDE, WIDTH)[:, STRIDE:] += own_back.reshape(n, STRIDE, WIDTH)
        g["embed"] = (inputs.reshape(-1), x_back)
        return loss + more, g


def _product(left: np.ndarray, right: np.ndarray, at_once: int = 256) -> np.ndarray:
    """left.T @ right of many rows, some at once."""
    if len(left) % at_once:
        return left.T @ right
    return (left.reshape(-1, at_once, left.shape[1]).transpose(0, 2, 1) @ right.reshape(-1, at_once, right.shape[1])).sum(0)


def blocks(ids: np.ndarray, first: np.ndarray, start_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of all positions in blocks, which blocks begin a document, and where each token and each end is predicted.

    A document of n tokens has n + 1 positions; the input of a position is the token before it.
    """
    size = np.diff(first)
    n_blocks = size // STRIDE + 1
    begin = np.cumsum(n_blocks) - n_blocks
    inputs = np.full(int(n_blocks.sum()) * STRIDE, start_id, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(ids)) - first[:-1][row] + begin[row] * STRIDE
    inputs[place + 1] = ids
    fresh = np.zeros(int(n_blocks.sum()), bool)
    fresh[begin] = True
    return inputs.reshape(-1, STRIDE), fresh, np.insert(place, first[1:], begin * STRIDE + size)


def train(
    ids: np.ndarray, first: np.ndarray, words: Vocabulary, steps: int = 800, batch: int = 128, rate: float = 0.01, seed: int = 0,
    model: Model | None = None,
) -> Model:
    """Adam on windows drawn from the documents ``ids[first[i]:first[i + 1]]``; goes on with ``model`` if given."""
    tokens = len(words.klass)
    model = model or Model(tokens, seed)
    inputs, fresh, place = blocks(ids, first, tokens)
    if not len(ids):
        return model
    targets = np.zeros(inputs.size, np.int64)
    real = np.zeros(inputs.size, bool)
    at = np.delete(place, first[1:] + np.arange(len(first) - 1))
    targets[at], real[at] = words.klass[ids], True
    targets, real = targets.reshape(-1, STRIDE), real.reshape(-1, STRIDE)
    make = np.random.default_rng(seed)
    # all weights but the tokens' are one array, which the model's are parts of
    small = [k for k in model.weights if k != "embed"]
    flat = np.concatenate([model.weights[k].ravel() for k in small])
    ends = np.cumsum([model.weights[k].size for k in small])
    change, mean, square = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    changes = {}
    for k, start, end in zip(small, np.append(0, ends), ends):
        shape = model.weights[k].shape
        model.weights[k], changes[k] = flat[start:end].reshape(shape), change[start:end].reshape(shape)
    embed = model.weights["embed"]
    means, squares = np.zeros_like(embed), np.zeros_like(embed)
    narrow = np.min_scalar_type(len(embed))  # numbers of 16 bits are sorted in two passes
    # a block and the one before it are neighbours; the first of all begins a document and sees none
    windows = np.lib.stride_tricks.sliding_window_view(np.append(inputs[0], inputs), 2 * STRIDE)[::STRIDE]
    queue = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        while len(queue) < batch:  # every window once before any comes again
            queue = np.append(queue, make.permutation(len(inputs)))
        pick, queue = queue[:batch], queue[batch:]
        _, gradients = model.gradients(windows[pick], fresh[pick], targets[pick], real[pick], False)
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1))) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for name, g in gradients.items():
            if name != "embed":
                changes[name][:] = g
        flat -= _moved(change, mean, square, speed)
        if "embed" in gradients:  # only the rows that were seen
            seen, g = gradients["embed"]
            order = np.argsort(seen.astype(narrow), kind="stable")
            sorted_ = seen.take(order)
            head = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            # two columns are summed as one number of two parts
            rows, g = sorted_[head], np.add.reduceat(g.take(order, axis=0).view(np.complex64), head, axis=0).view(np.float32)
            of_rows = means.take(rows, axis=0), squares.take(rows, axis=0)
            embed[rows] -= _moved(g, *of_rows, speed)
            means[rows], squares[rows] = of_rows
    return model


def _moved(change: np.ndarray, mean: np.ndarray, square: np.ndarray, speed: float) -> np.ndarray:
    """A step of Adam against changes; their mean and the mean of their squares are brought up to date."""
    mean *= 0.9
    mean += 0.1 * change
    square *= 0.99
    square += 0.01 * change * change
    out = np.sqrt(square)
    out += 1e-8
    np.divide(mean, out, out=out)
    out *= out.dtype.type(speed)
    return out


def token_scores(
    model: Model, words: Vocabulary, ids: np.ndarray, first: np.ndarray, at_once: int = 512, shares: np.ndarray | None = None
):
    """For each token and each end of a document: ln chance of the token (0 for an end), ln chance that a word begins or the text ends."""
    inputs, fresh, place = blocks(ids, first, len(words.klass))
    target = np.zeros(inputs.size, np.int64)
    ends = first[1:] + np.arange(len(first) - 1)
    token_place = np.delete(place, ends)
    target[token_place] = words.klass[ids]
    chosen, starts = np.empty(inputs.size, np.float32), np.empty(inputs.size, np.float32)
    # all groups, and those of tokens that begin a word
    sums = np.ones((2, GROUPS), np.float32)
    sums[1, words.starts // INNER :] = 0
    for low in range(0, len(inputs), at_once):
        from_ = max(low - 1, 0)
        hidden = model.hidden(inputs[from_ : low + at_once], fresh[from_ : low + at_once])[(low - from_) * STRIDE :]
        part = slice(low * STRIDE, low * STRIDE + len(hidden))
        goal = target[part]
        scores = model.weights["out"].T @ hidden.T
        scores += model.weights["out_bias"][:, None]
        chosen[part], starts[part] = _ln_chance(scores, goal // INNER, sums)
        chosen[part] += model.within(hidden, goal)
    token = np.zeros(len(place))
    keep = np.ones(len(place), bool)
    keep[ends] = False
    token[keep] = chosen[token_place] + (words.shares(inputs.ravel()[token_place], ids) if shares is None else shares)
    return token, starts[place].astype(np.float64)
