"""Language-model scores by a gated recurrent network in numpy, trained on Spark's partitions.

1. Words of all training documents are counted exactly. The most frequent ones are symbols of their own; the others share TAIL symbols
   cut by equal parts of their mass, the last of which also stands for the unknown. Symbols are dealt to classes by rank.
2. Documents become strings of symbols, two bytes a token. What a word's share of its symbol and the plain counts contribute is summed on
   the way. Counts of the COUNTED most frequent words are sent to the tasks; the others are counted by a join.
3. The softmax is factored by classes, both parts from the network's state: first the class, then the symbol among those of its class.
   Only the share of a rarer word in the symbol that it has in common with others doesn't depend on the text.
4. The network is trained on every training document, in ROUNDS rounds: each task starts from the round's weights, runs truncated
   backpropagation over its documents, and the weights are averaged by tokens. The loss is taken at every step, so each token is a target.
   A round has a third of the documents; each is seen once. Of a text longer than PIECE tokens, pieces are trained on side by side.
5. Each whole document is scored in windows; the state is carried from window to window and starts afresh with each document.

Texts run in lanes that are filled as they empty, window by window and over batches, so a task holds the texts in its lanes, one batch, and
some numbers for each document of a batch that isn't through; it never holds a matrix as long as a text.

Unknown words are one type, as in the base; both are distributions over all known types and that one. Averaged weights depend on how
documents lie in partitions, so scores of two runs differ a little if those do.

Edge cases: null and empty texts have the end as their only token; a null id counts as the empty text for the split; ties in counts are
ordered by hash; rows that repeat are scored alike; an empty table gives an empty result, and without training documents every symbol
is as likely. Only the id and the text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flankspark.llm.common import SPACED, U64, batched, blocks, cut, mix, most_frequent, signed, words_of

#: Classes, symbols of each, and symbols that stand for several words.
CLASSES, EACH, TAIL = 32, 64, 128
SYMBOLS = CLASSES * EACH
SINGLE = SYMBOLS - 1 - TAIL
#: Words whose counts are sent to the tasks: at most 16 bytes each.
COUNTED = 400_000
EMBEDDED, HIDDEN, LANES, STEPS, ROUNDS, RATE = 12, 16, 256, 16, 3, 0.01
#: Tokens whose gradients make a step at least, steps that lanes are filled for at once, and the bound of logits, whose exponents then are finite.
LEAST_TOKENS, FILLED, LIMIT = 512, 4 * STEPS, 80.0
#: Tokens of a text that are trained on in a row; the next ones start from a state of zero.
PIECE = 2048
#: Hash that stands for the end of a text, and its symbol.
END_HASH, END = mix(np.array([0xE0D], U64))[0], 0
RARE = SYMBOLS - 1
SYMBOL = np.uint16

# ---------------------------------------------------------------- the network


def fresh(seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    normal = lambda width, *shape: r.normal(0, width, shape).astype(np.float32)
    h, e = HIDDEN, EMBEDDED
    # The last row of v and u goes with a constant 1 after each state.
    return {
        "e": normal(0.3, SYMBOLS, e), "x": normal(e**-0.5, e, 3 * h), "g": normal(h**-0.5, h, 2 * h), "c": normal(h**-0.5, h, h), "v": normal(0.02, h + 1, CLASSES), "u": normal(0.02, CLASSES, h + 1, EACH),
    }


SHAPES = {k: v.shape for k, v in fresh().items()}


def pack(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def sigmoid(a: np.ndarray) -> np.ndarray:
    a *= 0.5
    np.tanh(a, out=a)
    a += 1
    a *= 0.5
    return a


def forward(w: dict, state: np.ndarray, inputs: np.ndarray, starts: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each of the steps, each followed by a 1; inputs and starts are (steps, lanes). A lane's state is zero where a text starts."""
    h = HIDDEN
    out = np.ones((*inputs.shape, h + 1), np.float32)
    x = (w["e"][inputs.ravel()] @ w["x"]).reshape(*inputs.shape, 3 * h)
    renewed = starts.any(1)
    for t in range(len(inputs)):
        if renewed[t]:
            state = state * ~starts[t][:, None]
        gates = state @ w["g"]
        gates += x[t, :, : 2 * h]
        sigmoid(gates)
        z, r = gates[:, :h], gates[:, h:]
        candidate = (r * state) @ w["c"]
        candidate += x[t, :, 2 * h :]
        np.tanh(candidate, out=candidate)
        new = candidate - state
        new *= z
        new += state
        if trace is not None:
            trace.append((state, z, r, candidate))
        out[t, :, :h] = state = new
    return out


class Softmax:
    """Both parts of the factored softmax for rows of states: exponents, their sums and the logarithms of the targets' probabilities.

    Rows are handled in order of the targets' classes, so the second part is one matrix product for each class.
    """

    def __init__(self, w: dict, rows: np.ndarray, targets: np.ndarray):
        self.w = w
        kind = (targets // EACH).astype(np.uint8)
        self.order = np.argsort(kind, kind="stable")
        self.rows, kind, within = rows.take(self.order, axis=0), kind[self.order], (targets % EACH)[self.order]
        self.bounds = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
        outer, inner = self.rows @ w["v"], np.empty((len(rows), EACH), np.float32)
        for c, a, b in self.blocks():
            np.matmul(self.rows[a:b], w["u"][c], out=inner[a:b])
        every = np.arange(len(rows))
        self.parts, found = [], np.zeros(len(rows), np.float32)
        for logits, wanted in ((outer, kind), (inner, within)):
            np.clip(logits, -LIMIT, LIMIT, out=logits)
            found += logits[every, wanted]
            np.exp(logits, out=logits)
            sums = logits @ np.ones(logits.shape[1], np.float32)
            found -= np.log(sums)
            self.parts.append((logits, sums, wanted))
        self.logs = np.empty_like(found)
        self.logs[self.order] = found

    def blocks(self) -> Iterator[tuple[int, int, int]]:
        return ((c, a, b) for c, (a, b) in enumerate(zip(self.bounds, self.bounds[1:], strict=False)) if b > a)

    def gradients(self, weight: np.ndarray | None, grads: dict) -> np.ndarray:
        """Adds the weights' gradients of the summed loss of rows with a weight of 1, and returns those of the states."""
        h, every = HIDDEN, np.arange(len(self.rows))
        for logits, sums, wanted in self.parts:
            logits *= (1 / sums)[:, None]
            logits[every, wanted] -= 1
            if weight is not None:
                logits *= weight[self.order][:, None]
        (outer, _, _), (inner, _, _) = self.parts
        grads["v"] += self.rows.T @ outer
        out = outer @ self.w["v"][:h].T
        for c, a, b in self.blocks():
            grads["u"][c] += self.rows[a:b].T @ inner[a:b]
            out[a:b] += inner[a:b] @ self.w["u"][c, :h].T
        back = np.empty_like(out)
        back[self.order] = out
        return back


def backward(w: dict, inputs: np.ndarray, targets: np.ndarray, starts: np.ndarray, valid: np.ndarray, trace: list, states: np.ndarray, grads: dict) -> None:
    """Adds the gradients of the summed loss over all steps of a window with a valid token."""
    h = HIDDEN
    steps, lanes = inputs.shape
    weight = None if valid.all() else valid.ravel().astype(np.float32)
    from_loss = Softmax(w, states.reshape(-1, h + 1), targets.ravel()).gradients(weight, grads).reshape(steps, lanes, h)
    flow = np.zeros((lanes, h), np.float32)
    dc, dg = np.empty((steps, lanes, h), np.float32), np.empty((steps, lanes, 2 * h), np.float32)
    before, turned = np.empty((steps, lanes, h), np.float32), np.empty((steps, lanes, h), np.float32)
    back_c, back_g = np.ascontiguousarray(w["c"].T), np.ascontiguousarray(w["g"].T)
    renewed = starts.any(1)
    for t in range(steps - 1, -1, -1):
        flow += from_loss[t]
        state, z, r, candidate = trace[t]
        before[t] = state
        np.multiply(r, state, out=turned[t])
        now = dc[t]
        np.multiply(candidate, candidate, out=now)
        np.subtract(1, now, out=now)
        now *= z
        now *= flow
        back = now @ back_c
        candidate -= state
        candidate *= flow
        keep = 1 - z
        candidate *= z
        np.multiply(candidate, keep, out=dg[t, :, :h])
        np.multiply(turned[t], back, out=candidate)
        candidate *= 1 - r
        dg[t, :, h:] = candidate
        flow *= keep
        back *= r
        flow += back
        flow += dg[t] @ back_g
        if renewed[t]:
            flow *= ~starts[t][:, None]
    dc, dg = dc.reshape(-1, h), dg.reshape(-1, 2 * h)
    grads["c"] += turned.reshape(-1, h).T @ dc
    grads["g"] += before.reshape(-1, h).T @ dg
    flat = inputs.ravel()
    given = w["e"][flat].T
    grads["x"][:, : 2 * h] += given @ dg
    grads["x"][:, 2 * h :] += given @ dc
    # Rows of the same symbol are summed by sorting.
    de = dg @ w["x"][:, : 2 * h].T
    de += dc @ w["x"][:, 2 * h :].T
    order = np.argsort(flat, kind="stable")
    heads = np.flatnonzero(np.diff(flat[order].astype(np.int32), prepend=-1))
    grads["e"][flat[order[heads]]] += np.add.reduceat(de.take(order, axis=0), heads, axis=0)


class Adam:
    def __init__(self, w: dict, rate: float = RATE):
        self.w, self.rate, self.n = w, rate, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))

    def step(self, grads: dict, tokens: int) -> None:
        """A step along gradients that are sums over so many tokens; they are used up."""
        self.n += 1
        norm = float(np.sqrt(sum(np.vdot(g, g) for g in grads.values()))) / tokens
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-6)) / tokens)
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n))
        for k, g in grads.items():
            m, s = self.m[k], self.s[k]
            g *= scale
            m *= 0.9
            m += 0.1 * g
            g *= g
            s *= 0.99
            s += 0.01 * g
            np.sqrt(s, out=g)
            g += 1e-7
            np.divide(m, g, out=g)
            g *= rate
            self.w[k] -= g


# ---------------------------------------------------------------- lanes


class Window:
    """Some steps of all lanes: (steps, lanes) of inputs, targets, starts of texts and whether there is a token, and the pieces of texts in it."""

    __slots__ = ("inputs", "kept", "pieces", "starts", "targets", "valid")

    def __init__(self, inputs, targets, starts, valid, kept, pieces):
        self.inputs, self.targets, self.starts, self.valid = (np.ascontiguousarray(x.T) for x in (inputs, targets, starts, valid))
        self.kept, self.pieces = kept, pieces

    def parts(self, steps: int = STEPS) -> Iterator[slice]:
        """Stretches of steps, up to the last one with a token."""
        size = int(np.flatnonzero(self.valid.any(1))[-1]) + 1
        return (slice(a, min(size, a + steps)) for a in range(0, size, steps))


def windows(texts: Iterator[np.ndarray], lanes: int = LANES, steps: int = FILLED) -> Iterator[Window]:
    """Texts one after another in lanes that run in step; a lane takes the next text where its last one ended.

    kept are the lanes of the window before that go on, in order; pieces are rows (text, lane, first step, end, whether the text ends).
    """
    numbered = enumerate(texts)
    running: list[tuple[int, np.ndarray, int]] = []
    for number, text in numbered:
        running.append((number, text, 0))
        if len(running) == lanes:
            break
    kept = np.arange(len(running))
    while running:
        n = len(running)
        inputs, targets = np.full((n, steps), END, SYMBOL), np.zeros((n, steps), SYMBOL)
        starts, valid = np.zeros((n, steps), bool), np.ones((n, steps), bool)
        pieces, on = [], []
        for lane, (number, text, place) in enumerate(running):
            at = 0
            while at < steps:
                size = min(steps - at, len(text) - place)
                targets[lane, at : at + size] = text[place : place + size]
                if place:
                    inputs[lane, at : at + size] = text[place - 1 : place + size - 1]
                else:
                    starts[lane, at] = True
                    inputs[lane, at + 1 : at + size] = text[: size - 1]
                at, place = at + size, place + size
                pieces.append((number, lane, at - size, at, place == len(text)))
                if place == len(text):
                    number, text = next(numbered, (None, None))
                    if text is None:
                        break
                    place = 0
            valid[lane, at:] = False
            if text is not None:
                on.append((lane, (number, text, place)))
        yield Window(inputs, targets, starts, valid, kept, np.array(pieces, np.int64))
        kept, running = np.array([lane for lane, _ in on], np.int64), [x for _, x in on]


def train(w: dict, texts: Iterator[np.ndarray], adam: Adam) -> int:
    """Changes the weights along the loss of every token of the texts, of which it returns the number. Gradients of few tokens wait for more."""
    state = np.zeros((LANES, HIDDEN), np.float32)
    grads, waiting, tokens = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}, 0, 0
    for window in windows(texts):
        state = state[window.kept]
        for part in window.parts():
            trace: list = []
            states = forward(w, state, window.inputs[part], window.starts[part], trace)
            state = states[-1, :, :HIDDEN].copy()
            backward(w, window.inputs[part], window.targets[part], window.starts[part], window.valid[part], trace, states, grads)
            waiting += int(window.valid[part].sum())
            if waiting >= LEAST_TOKENS:
                adam.step(grads, waiting)
                for g in grads.values():
                    g[...] = 0
                tokens, waiting = tokens + waiting, 0
    if waiting:
        adam.step(grads, waiting)
    return tokens + waiting


def scores(w: dict, texts: Iterator[np.ndarray]) -> Iterator[tuple[int, float]]:
    """(number of the text, natural logarithm of its probability) of each text, as they end."""
    state = np.zeros((LANES, HIDDEN), np.float32)
    open_: dict[int, float] = {}
    for window in windows(texts):
        state = state[window.kept]
        upto = np.zeros((FILLED + 1, len(state)))
        for part in window.parts():
            states = forward(w, state, window.inputs[part], window.starts[part])
            state = states[-1, :, :HIDDEN].copy()
            upto[part.start + 1 : part.stop + 1] = Softmax(w, states.reshape(-1, HIDDEN + 1), window.targets[part].ravel()).logs.reshape(-1, len(state))
        np.cumsum(upto, axis=0, out=upto)
        number, lane, first, end, last = window.pieces.T
        for k, part, ends in zip(number.tolist(), (upto[end, lane] - upto[first, lane]).tolist(), last.tolist(), strict=True):
            total = open_.pop(k, 0.0) + part
            if ends:
                yield k, total
            else:
                open_[k] = total


# ---------------------------------------------------------------- counts and symbols


class Vocabulary:
    """Counts of the most frequent words by hash, and each one's symbol and share of its symbol."""

    def __init__(self, top: list[tuple[int, int]], tokens: int, types: int):
        """top: (hash, count), most frequent first, the end left out but counted in tokens and types."""
        self.tokens, self.types = tokens, types
        hashes = np.array([h for h, _ in top], np.int64).view(U64)
        counts = np.array([c for _, c in top], np.int64)
        symbols = np.full(len(top), RARE, np.int64)
        symbols[:SINGLE] = np.arange(1, min(SINGLE, len(top)) + 1)
        # The words between, with what lies beyond them, in groups of equal mass; what is left with the last is rare.
        rest = counts[SINGLE:]
        beyond = max(1, tokens - int(counts[:SINGLE].sum()))
        groups = TAIL
        if len(rest):
            symbols[SINGLE:] = np.minimum(RARE, SINGLE + 1 + (np.cumsum(rest) - rest) * groups // beyond)
        mass = np.bincount(symbols, counts, SYMBOLS)
        share = np.log10(counts / np.maximum(1, mass[symbols]))
        order = np.argsort(hashes)
        self.hashes, self.counts, self.symbols, self.share = hashes[order], counts[order], symbols[order].astype(SYMBOL), share[order]
        self.is_rare = self.symbols == RARE
        self.end_count, self.rare_total = 0, 1
        self.mass = mass

    def set_end(self, count: int) -> None:
        """What remains for the rare symbol once the end's count is known: the words of no other symbol, and one type for the unknown."""
        plain = ~self.is_rare
        mass = self.tokens - count - int(self.counts[plain].sum())
        types = self.types - (count > 0) - int(plain.sum())
        self.end_count = count
        self.rare_total = max(0, mass) + max(0, types) + 1
        self.share[self.is_rare] = np.log10((self.counts[self.is_rare] + 1) / self.rare_total)
        self.mass[END], self.mass[RARE] = count, self.rare_total

    def start(self) -> dict[str, np.ndarray]:
        """Weights from which training starts: the constant's are logarithms of the classes' parts of all tokens and the symbols' of their classes."""
        w, mass = fresh(), (self.mass + 0.5).reshape(CLASSES, EACH)
        w["v"][HIDDEN], w["u"][:, HIDDEN] = np.log(mass.sum(1) / mass.sum()), np.log(mass / mass.sum(1, keepdims=True))
        return w

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, known) of each hash among those with counts here."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n) of the words of texts, and of their ends; summed over as many texts as memory for a few million words allows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.diff(keys, prepend=keys[:1] + U64(1)))
        return keys[heads], np.add.reduceat(counts, heads)

    def out(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(counts)], names=["h", "n"])

    for batch in batches:
        for _, _, data, offsets in blocks(batch.column(0)):
            words = words_of(data, offsets, SPACED)
            keys, counts = np.unique(words.hashes, return_counts=True)
            held.append((np.append(keys, END_HASH), np.append(counts, len(words))))
        if sum(len(k) for k, _ in held) > 2_000_000:
            held = [merged()]
            if len(held[0][0]) > 1_000_000:
                yield out(*held[0])
                held = []
    if held:
        yield out(*merged())


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        scale = np.log10(v.tokens + v.types + 1)
        for batch in batches:
            symbols, odds, times = [], [], []
            tokens, known, base, inner, found = (np.zeros(batch.num_rows, k) for k in (np.int64, np.int64, np.float64, np.float64, np.int32))
            for first, end, data, offsets in blocks(batch.column(1)):
                words = words_of(data, offsets, SPACED)
                at, hit = v.find(words.hashes)
                symbol = np.full(len(at), RARE, SYMBOL)
                symbol[hit] = v.symbols[at[hit]]
                sums = np.zeros((3, len(at) + 1))
                sums[0, 1:][hit] = np.log10(v.counts[at[hit]] + 1.0)
                sums[1, 1:][hit] = v.share[at[hit]]
                sums[2, 1:] = hit
                for row, a, b in zip(range(first, end), words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
                    symbols.append(np.append(symbol[a:b], SYMBOL(END)).tobytes())
                    base[row], inner[row], known[row] = sums[:, a + 1 : b + 1].sum(1)
                    odd, n = np.unique(words.hashes[a:b][~hit[a:b]], return_counts=True)
                    odds.append(odd)
                    times.append(n)
                    found[row] = len(odd)
                tokens[first:end] = np.diff(words.offsets) + 1
            base += np.log10(v.end_count + 1.0) - tokens * scale
            known += v.end_count > 0
            odd = pa.StructArray.from_arrays([pa.array(signed(np.concatenate(odds or [np.zeros(0, U64)]))), pa.array(np.concatenate(times or [np.zeros(0, np.int64)]).astype(np.int64))], ["h", "n"])
            rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(found)]), pa.int32()), odd)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(symbols, pa.binary()), pa.array(tokens), pa.array(known), pa.array(base), pa.array(inner), rare],
                names=["id", "held_out", "symbols", "n_tokens", "known", "base", "inner", "rare"],
            )

    return run


def _texts(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, SYMBOL) for x in column.to_pylist()]


def longest_first(texts: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """(place, text), so that lanes with long texts don't run on alone at the end."""
    return sorted(enumerate(texts), key=lambda x: -len(x[1]))


def pieces(text: np.ndarray, size: int = PIECE) -> Iterator[np.ndarray]:
    return (text[a : a + size] for a in range(0, len(text), size))


def _train(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unpack(shared.value)
        tokens = train(w, (piece for batch in batches for text in longest_first(_texts(batch.column(0))) for piece in pieces(text[1])), Adam(w))
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([pack(w).tobytes()], pa.binary())], names=["tokens", "weights"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = None, 0
    for batch in batches:
        for n, flat in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(flat, np.float32).astype(np.float64) * n
            total, tokens = part if total is None else total + part, tokens + n
    if tokens:
        yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([(total / tokens).astype(np.float32).tobytes()], pa.binary())], names=["tokens", "weights"])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unpack(shared.value)
        #: The batch and row of each text that isn't through; a batch is its columns but the symbols, scores, and how many are open.
        whose: dict[int, tuple[list, int]] = {}

        def texts() -> Iterator[np.ndarray]:
            number = 0
            for batch in batches:
                keep = [i for i, n in enumerate(batch.schema.names) if n != "symbols"]
                columns = [batch.column(i) for i in keep], [batch.schema.names[i] for i in keep]
                own = [columns, np.zeros(batch.num_rows), batch.num_rows]
                for row, text in longest_first(_texts(batch.column(batch.schema.get_field_index("symbols")))):
                    whose[number] = own, row
                    number += 1
                    yield text

        for number, log in scores(w, texts()):
            own, row = whose.pop(number)
            own[1][row] = log / np.log(10)
            own[2] -= 1
            if not own[2]:
                (columns, names), found = own[:2]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*names, "outer"])

    return run


def fit_vocabulary(training: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of the texts of training, and all counts (h, n)."""
    counts = cut(training.mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end = int(signed(np.array([END_HASH]))[0])
    top = most_frequent(counts.where(F.col("h") != end), "h", "n", COUNTED)
    vocabulary = Vocabulary(top, tokens, types)
    vocabulary.set_end((counts.where(F.col("h") == end).agg(F.sum("n")).first()[0]) or 0)
    return vocabulary, counts


def fit_network(coded: DataFrame, start: dict[str, np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights trained on all symbols of coded(symbols, round), from those given."""
    context = coded.sparkSession.sparkContext
    weights = pack(start)
    for k in range(rounds):
        trained = coded.where(F.col("round") == k).select("symbols").mapInArrow(_train(context.broadcast(weights)), "tokens long, weights binary")
        # Sums over groups of tasks first; the driver gets a few sets of weights.
        rows = trained.repartition(8).mapInArrow(_average, "tokens long, weights binary").collect()
        if rows:
            total = sum(r[0] for r in rows)
            weights = (sum(np.frombuffer(r[1], np.float32).astype(np.float64) * r[0] for r in rows) / total).astype(np.float32)
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs."""
    spark = docs.sparkSession
    batched(spark)
    held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == held
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"), held_out.alias("held_out"))
    vocabulary, counts = fit_vocabulary(slim.where("not held_out").select("text"))
    schema = "id long, held_out boolean, symbols binary, n_tokens long, known long, base double, inner double, rare array<struct<h:long,n:long>>"
    coded = cut(slim.mapInArrow(_encode(spark.sparkContext.broadcast(vocabulary)), schema).withColumn("row", F.monotonically_increasing_id()))
    weights = fit_network(coded.where("not held_out").select("symbols", F.pmod(F.xxhash64("id", "n_tokens"), F.lit(ROUNDS)).alias("round")), vocabulary.start())

    # Words without a count here, by a join with all counts.
    odd = coded.where(F.size("rare") > 0).select("row", F.explode("rare").alias("x")).select("row", "x.h", F.col("x.n").alias("times"))
    met = odd.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("odd_logs"), F.sum("times").alias("odd_tokens"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("odd_known")
    )
    plain = coded.select("row", "id", "held_out", "symbols", "n_tokens", "known", "base", "inner")
    kinds = "row long, id long, held_out boolean, n_tokens long, known long, base double, inner double, outer double"
    scored = plain.mapInArrow(_score(spark.sparkContext.broadcast(weights)), kinds)
    out = scored.join(sums, "row", "left").na.fill({"odd_logs": 0.0, "odd_tokens": 0, "odd_known": 0})
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.col("odd_known")).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("odd_logs")).alias("base_score"),
        (F.col("outer") + F.col("inner") + F.col("odd_logs") - F.col("odd_tokens") * F.lit(float(np.log10(vocabulary.rare_total)))).alias("score"),
    )
