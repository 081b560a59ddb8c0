"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds to them.

Patterns find e-mail addresses, IP addresses, card numbers (with check digit) and phone numbers. The network is trained in
numpy from labelled spans: stretches of at most ``FIT_TEXTS`` documents into which written-out personal data of all
kinds and look-alikes (versions, dates, keys, sums) are placed by a seeded generator. It tags every character of every
text: texts are cut into windows of ``WINDOW`` characters that overlap by ``OVERLAP``, each window is decoded by Viterbi, and
windows are reconciled over the whole text: a character takes its tag from the window in which it lies further from the
edge, spans are read off the joined tags, so one may run over several windows. A span of the network must pass the check
of its kind (digits, ranges, check digit) and may not touch a span of the patterns; those always stay.

Windows with the same characters are decoded once per run of texts. Positions are code points, ends are exclusive.

A null text counts as empty and has no spans; repeated rows stay; a null id stays null; without documents the training
text is made of random letters. All matching is linear in the length of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.sampling import hash_border

from .tables import texts_of

KINDS = ("email", "ip", "card", "phone")
HIDDEN, WINDOW, OVERLAP = 10, 256, 48
#: Windows decoded together, and characters tagged at once.
BATCH, SLICE = 2048, 400_000
FIT_TEXTS, FIT_CHARS = 400, 2000
TRAIN_WINDOWS, TRAIN_LENGTH, EPOCHS = 2400, 72, 9

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits unless it starts at the run's beginning, so the look-behind only saves time.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[int, int, int]  # start, number of the kind, end


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def is_card(text: str) -> bool:
    return 12 <= len(d := digits_of(text)) <= 19 and luhn(d)


def is_address(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(d := p.lstrip("0")) <= 3 and int(d or "0") <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = last = 0
    at = text.find("@")
    while at >= 0:
        before = text[max(end, last) : at]
        run = len(before) - len(before.rstrip(LOCAL_PART))
        last = at + 1
        if at >= end and run and (m := DOMAIN.match(text, at)):
            yield at - run, m.end()
            end = m.end()
        at = text.find("@", last)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by start, then kind."""
    found = [(s, 0, e) for s, e in emails(text)]
    found += [(m.start(), 1, m.end()) for m in ADDRESS.finditer(text) if is_address(m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m[0])]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(found)


def plausible(kind: int, text: str) -> bool:
    """Whether a span of the network can be what it says."""
    digits = digits_of(text)
    if kind == 0:
        low = text.lower()
        parted = re.split(r"\s*[\[({<]?\s*(?:@|\bat\b)\s*[\])}>]?\s*", low)
        return len(parted) == 2 and all(parted) and bool(re.search(r"\.|\bdot\b", parted[1])) and "\n" not in low
    if kind == 1:
        return is_address(re.findall("[0-9]+", text)) and not re.search("[A-Za-z]", text.lower().replace("dot", ""))
    if kind == 2:
        return is_card(text) and not re.search("[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and not re.search("[A-Za-z]", text) and not is_address(re.findall("[0-9]+", text))


# --- characters ----------------------------------------------------------------------------------------------------

MARKS = "abcdefghijklmnopqrstuvwxyz0 \n.,:;!?@#$%&*+-_=/\\|'\"()[]{}<>~^`"
OTHER, EDGE = len(MARKS), len(MARKS) + 1
CLASSES = len(MARKS) + 2


def _class_table() -> np.ndarray:
    """Class of each code point below 128: letters without case, all digits as one."""
    table = np.full(129, OTHER, np.uint8)
    for i, c in enumerate(MARKS):
        table[ord(c)] = i
        table[ord(c.upper())] = i
    table[ord("0") : ord("9") + 1] = MARKS.index("0")
    for c in "\t\r\v\f":
        table[ord(c)] = MARKS.index(" ")
    return table


CLASS_OF = _class_table()


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return CLASS_OF[np.minimum(codes, 128)]


# --- the network ---------------------------------------------------------------------------------------------------


@dataclass
class Network:
    """Gates are stacked as input, forget, output, candidate. Arrays: x (4H, classes), u (4H, H) and b (4H) of each
    direction, e (tags, 2H) and eb (tags) of the emissions, t (tags, tags) of the transitions."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator, hidden: int = HIDDEN) -> Network:
        tags = len(KINDS) + 1
        p = {}
        for d in "fb":
            p["x" + d] = rng.normal(0, 0.3, (4 * hidden, CLASSES))
            p["u" + d] = rng.normal(0, 0.3, (4 * hidden, hidden))
            p["b" + d] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)[:, None]
        p |= {"e": rng.normal(0, 0.3, (tags, 2 * hidden)), "eb": np.zeros((tags, 1)), "t": np.zeros((tags, tags))}
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """(T, tags, B) for characters (T, B). A sigmoid is 1 / (1 + exp(-x)), a tanh twice the sigmoid of 2 x, less 1; the signs and
        factors are in the weights. The cell is kept as -2 c and its output as h / 2, so that both need no steps of their own."""
        steps, batch = chars.shape
        n, tags = self.p["uf"].shape[1], len(self.p["eb"])
        scale = np.repeat(np.float32([-1, -1, -1, -2]), n)[:, None]
        out = np.empty((steps, tags, batch), np.float32)
        out[:] = self.p["eb"]
        z, x, h = np.empty((4, batch, n), np.float32), np.empty((batch, n), np.float32), np.empty((batch, n), np.float32)
        emitted = np.empty((tags, batch), np.float32)
        i, f, o, g = z
        for d, order, e in (("f", range(steps), self.p["e"][:, :n]), ("b", range(steps - 1, -1, -1), self.p["e"][:, n:])):
            by_gate = ((self.p["x" + d] + self.p["b" + d]) * scale).reshape(4, n, -1)
            table = np.ascontiguousarray(by_gate.transpose(0, 2, 1))
            u = np.ascontiguousarray((2 * self.p["u" + d] * scale).reshape(4, n, n).transpose(0, 2, 1))
            e, c = np.ascontiguousarray(2 * e), np.zeros((batch, n), np.float32)
            h[:] = 0
            with np.errstate(over="ignore"):  # 1 / (1 + infinity) is the 0 it should be
                for t in order:
                    np.matmul(h, u, out=z)
                    at = chars[t].astype(np.intp)
                    for gate, rows in zip(z, table):
                        np.take(rows, at, axis=0, out=x, mode="clip")
                        gate += x
                    np.exp(z, out=z)
                    z += 1
                    np.reciprocal(z, out=z)
                    g *= -4
                    g += 2
                    g *= i
                    c *= f
                    c += g
                    np.exp(c, out=h)
                    h += 1
                    np.reciprocal(h, out=h)
                    h -= 0.5
                    h *= o
                    np.matmul(e, h.T, out=emitted)
                    out[t] += emitted
        return out

    def decode(self, chars: np.ndarray) -> np.ndarray:
        """Best tags (T, B) by Viterbi; of equally good ones the first."""
        best = self.emissions(chars)
        steps, tags, batch = best.shape
        trans = np.ascontiguousarray(self.p["t"])
        sums, top, more = np.empty((tags, batch), np.float32), np.empty(batch, np.float32), np.empty(batch, bool)
        for before, now in zip(best, best[1:]):
            for j in range(tags):
                np.add(before, trans[:, j, None], out=sums)
                now[j] += sums.max(axis=0, out=top)
        out = np.zeros((steps, batch), np.int8)
        out[-1] = best[-1].argmax(axis=0)
        for t in range(steps - 1, 0, -1):
            np.take(trans, out[t], axis=1, out=sums, mode="clip")
            sums += best[t - 1]
            top[:] = sums[0]
            for j in range(1, tags):
                np.greater(sums[j], top, out=more)
                np.copyto(out[t - 1], j, where=more)
                np.maximum(top, sums[j], out=top)
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def loss_and_gradient(net: Network, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood per window of the tags (T, B), and its gradient."""
    p, grad = net.p, {k: np.zeros_like(v) for k, v in net.p.items()}
    steps, batch = chars.shape
    n = p["uf"].shape[1]
    sig = lambda v: 0.5 * np.tanh(0.5 * v) + 0.5
    kept = {}
    emit = np.empty((steps, len(p["eb"]), batch), np.float32)
    emit[:] = p["eb"]
    for d, order, e in (("f", list(range(steps)), p["e"][:, :n]), ("b", list(range(steps))[::-1], p["e"][:, n:])):
        h = c = np.zeros((n, batch), np.float32)
        kept[d] = {}
        for t in order:
            z = p["x" + d][:, chars[t]] + p["u" + d] @ h + p["b" + d]
            i, f, o, g = sig(z[:n]), sig(z[n : 2 * n]), sig(z[2 * n : 3 * n]), np.tanh(z[3 * n :])
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            kept[d][t] = (h, c, i, f, o, g, tc, o * tc)
            h, c = o * tc, new_c
            emit[t] += e @ h
    trans, count = p["t"], np.arange(batch)
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[0] = emit[0]
    for t in range(1, steps):
        alpha[t] = emit[t] + _log_sum(alpha[t - 1][:, None] + trans[:, :, None], 0)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(trans[:, :, None] + (emit[t + 1] + beta[t + 1])[None], 1)
    total = _log_sum(alpha[-1], 0)
    gold = sum(emit[t, tags[t], count] for t in range(steps)) + sum(trans[tags[t - 1], tags[t]] for t in range(1, steps))
    d_emit = np.exp(alpha + beta - total)
    for t in range(steps):
        d_emit[t, tags[t], count] -= 1
    d_emit /= batch
    for t in range(1, steps):
        pair = np.exp(alpha[t - 1][:, None] + trans[:, :, None] + (emit[t] + beta[t])[None] - total)
        grad["t"] += pair.sum(axis=2) / batch
        np.add.at(grad["t"], (tags[t - 1], tags[t]), -1 / batch)
    grad["eb"] += d_emit.sum(axis=(0, 2))[:, None]
    for d, order, part in (("f", list(range(steps))[::-1], slice(0, n)), ("b", list(range(steps)), slice(n, 2 * n))):
        dh = dc = np.zeros((n, batch), np.float32)
        for t in order:
            h0, c0, i, f, o, g, tc, h = kept[d][t]
            grad["e"][:, part] += d_emit[t] @ h.T
            dh = dh + p["e"][:, part].T @ d_emit[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
            grad["u" + d] += dz @ h0.T
            grad["b" + d] += dz.sum(axis=1, keepdims=True)
            np.add.at(grad["x" + d].T, chars[t], dz.T)
            dh, dc = p["u" + d].T @ dz, dc * f
    return float((total - gold).mean()), grad


# --- training text -------------------------------------------------------------------------------------------------


def written(rng: np.random.Generator, kind: int) -> str:
    """Personal data of a kind in one of the ways people write it. All of it is made up."""
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 8)))
    pick = lambda *x: x[rng.integers(len(x))]
    if kind == 0:
        at, dot = pick(("@", "."), ("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" @ ", "."))
        name = word() + pick("", ".", "_", "-") + pick(word(), number(2))
        return name + at + word() + pick("", number(1)) + dot + pick("", word() + dot) + pick("com", "org", "net", "de", "info")
    if kind == 1:
        return pick(".", ".", "[.]", " . ", " dot ").join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == 2:
        body = [int(c) for c in pick("4", "5", "3", "6") + number(14)]
        body.append(next(d for d in range(10) if luhn([*body, d])))
        text = "".join(map(str, body))
        return pick("", "-", " ", ".", "_", "/", "  ").join(text[k : k + 4] for k in range(0, 16, 4))
    a, b, c = number(3), number(3), number(4)
    return pick(f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{rng.integers(1, 99)} {a} {b} {c}", f"00{rng.integers(1, 99)} {a} {b} {c}", f"{a} {b} {c}", f"1-{a}-{b}-{c}")


def look_alike(rng: np.random.Generator) -> str:
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda *x: x[rng.integers(len(x))]
    key = "".join(rng.choice(list("0123456789abcdef"), rng.integers(16, 40)))
    return pick(
        f'token = "{key}"', key, f"version {rng.integers(9)}.{rng.integers(9)}", f"Version {rng.integers(9)}.{rng.integers(9)}.{rng.integers(9)}.", f"{rng.integers(1900, 2100)}-{number(2)}-{number(2)}",
        f"{number(2)}:{number(2)}", f"${number(3)}.{number(2)}", f"BY-NC {rng.integers(5)}.0.", number(int(rng.integers(1, 9))), f"{number(5)}-{number(2)}", f"#{number(4)}", f"{number(1)},{number(3)},{number(3)}", f"{number(3)} - {number(3)}", f"at {number(2)} dot", f"id {number(24)}", "@" + "".join(rng.choice(list("abcdefgh"), 6)),
    )


def training_windows(texts: list[str], rng: np.random.Generator, windows: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, windows) of characters and tags."""
    texts = [t for t in texts if len(t) >= length] or ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    \n."), 5000))]
    chars, tags = np.empty((windows, length), np.uint8), np.zeros((windows, length), np.int64)
    for w in range(windows):
        t = texts[rng.integers(len(texts))]
        at = rng.integers(0, len(t) - length + 1)
        piece, marks = t[at : at + length], [0] * length
        for s, k, e in base_spans(piece):
            marks[s:e] = [k + 1] * (e - s)
        for _ in range(rng.integers(0, 3)):
            kind = int(rng.integers(-2, len(KINDS)))
            new = look_alike(rng) if kind < 0 else written(rng, kind)
            gaps = [i for i, c in enumerate(piece) if c in " \n" and not marks[i]] or [len(piece) - 1]
            i = gaps[rng.integers(len(gaps))] + 1
            piece = piece[:i] + new + " " + piece[i:]
            marks = marks[:i] + [kind + 1 if kind >= 0 else 0] * len(new) + [0] + marks[i:]
        cut = rng.integers(0, len(piece) - length + 1)
        chars[w], tags[w] = classes(piece[cut : cut + length]), marks[cut : cut + length]
    return chars.T.copy(), tags.T.copy()


def train(texts: list[str], seed: int = 5, windows: int = TRAIN_WINDOWS, epochs: int = EPOCHS, batch: int = 48) -> Network:
    """Adam on windows of the texts with labelled spans placed in them."""
    rng = np.random.default_rng(seed)
    chars, tags = training_windows(texts, rng, windows, TRAIN_LENGTH)
    net = Network.fresh(rng)
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step, steps = 0, epochs * (windows // batch)
    for _ in range(epochs):
        order = rng.permutation(windows)
        for at in range(0, windows - batch + 1, batch):
            some = order[at : at + batch]
            _, grad = loss_and_gradient(net, chars[:, some], tags[:, some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            rate = 0.02 * (1 - step / (steps + 1)) + 0.001
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.p[k] = (net.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, texts: int = FIT_TEXTS) -> Network:
    """Trains on one stretch of FIT_CHARS characters from each of ``texts`` documents: those with the smallest hash of their id,
    each stretch at a place that another hash gives."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("whole")).filter("whole IS NOT NULL")
    hashed = F.xxhash64("doc_id")
    few = whole.filter(hashed <= hash_border(whole, hashed, texts))
    begin = F.pmod(F.xxhash64(F.lit("begin"), "doc_id"), F.greatest(F.length("whole") - FIT_CHARS, F.lit(0)) + 1)
    some = few.select("doc_id", F.substr("whole", (begin + 1).cast("int"), F.lit(FIT_CHARS)).alias("text"))
    return train([r["text"] for r in some.orderBy(hashed, "doc_id", "text").limit(texts).collect()])


# --- tagging -------------------------------------------------------------------------------------------------------


def window_starts(n: int) -> range:
    return range(0, max(n - OVERLAP, 1), WINDOW - OVERLAP)


def tag_texts(net: Network, texts: list[str]) -> list[np.ndarray]:
    """Tag of every character of every text."""
    coded = [classes(t) for t in texts]
    rows = [(k, s) for k, c in enumerate(coded) for s in window_starts(len(c)) if len(c)]
    stack = np.full((len(rows), WINDOW), EDGE, np.uint8)
    for r, (k, s) in enumerate(rows):
        piece = coded[k][s : s + WINDOW]
        stack[r, : len(piece)] = piece
    keys = [stack[r].tobytes() for r in range(len(rows))]
    place = {key: i for i, key in enumerate(dict.fromkeys(keys))}
    distinct = np.frombuffer(b"".join(place), np.uint8).reshape(-1, WINDOW) if place else stack
    tagged = np.empty(distinct.shape, np.int8)
    for at in range(0, len(distinct), BATCH):
        tagged[at : at + BATCH] = net.decode(np.ascontiguousarray(distinct[at : at + BATCH].T)).T
    out = [np.zeros(len(c), np.int8) for c in coded]
    for key, (k, s) in zip(keys, rows):
        near = s + (OVERLAP // 2 if s else 0)  # the half of the overlap nearer to the window before belongs to it
        end = min(s + WINDOW, len(out[k]))
        out[k][near:end] = tagged[place[key]][near - s : end - s]
    return out


def read_spans(tags: np.ndarray) -> list[Span]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
    return [(int(a), int(tags[a]) - 1, int(b)) for a, b in zip(edges, edges[1:]) if a < len(tags) and tags[a]]


def reconciled(text: str, base: list[Span], tags: np.ndarray) -> list[Span]:
    """Base spans and the plausible spans of the network that touch none of them."""
    if not tags.any():
        return base
    taken = np.zeros(len(text) + 1, bool)
    for s, _, e in base:
        taken[s:e] = True
    added = []
    for s, kind, e in read_spans(tags):
        while s < e and text[s] in " \n\t.,;:!?\"'":
            s += 1
        while e > s and text[e - 1] in " \n\t.,;:!?\"'":
            e -= 1
        whole = (s == 0 or not text[s - 1].isalnum()) and (e == len(text) or not text[e].isalnum())
        if s < e and whole and not taken[s:e].any() and plausible(kind, text[s:e]):
            added.append((s, kind, e))
    return sorted(base + added)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def found(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the pattern spans) and spans (all) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def result(ids: list, texts: list[str]) -> pa.RecordBatch:
        rows = []
        for doc_id, text, tags in zip(ids, texts, tag_texts(shared.value, texts)):
            base = base_spans(text)
            counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
            rows.append((doc_id, *counts, sha256(spans_text(base).encode()).hexdigest(), spans_text(reconciled(text, base, tags))))
        types = [pa.int64()] * (1 + len(KINDS)) + [pa.string()] * 2
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids.append(doc_id)
                texts.append(text.decode("utf-8", "replace"))
                size += len(texts[-1])
                if size >= SLICE:
                    yield result(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield result(ids, texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInArrow(run, schema)
