"""Personal data by fixed patterns and a character-level BiLSTM with a CRF on top.

The patterns (``base_spans``) find well-formed e-mail addresses, IPv4 addresses, card numbers
and phone numbers; what they find always stays. The tagger adds spans that the patterns
miss: phone numbers without a plus, cards with other separators, addresses written with
``(at)`` or ``[dot]``. It is trained in numpy on the driver from labelled spans: pattern spans
of a bounded sample of documents, and generated spans of the four kinds (with the
variants above) set into text of the same documents, labelled by construction.

Tagging cuts a text into windows of ``WINDOW`` characters, half overlapping. A span needs a digit,
an at sign or a written-out one, so a window without any cannot give a span that passes the checks
below, and is not decoded; every other window of every text is. Each
window is decoded by Viterbi. A span's place in its window decides between windows: the
reading with more context on both sides wins, overlapping ones give way. A span
counts only if its text, with separators and written-out signs resolved, is valid for
its kind (Luhn, address parts up to 255, number of digits).

Nothing is shuffled; the model (a few kilobytes) is sent with the tasks.

Edge cases: a null or empty text has no spans. Repeated rows are each tagged. Without documents the
model is trained on generated spans alone. Pattern spans of different kinds may overlap and are all
reported; a tagger span that overlaps any pattern span is dropped.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, least_hashed, strings

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GATE = re.compile(r"[0-9@]|[(\[][aA][tT][)\]]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Pattern spans by kind, then start. Takes time linear in the text."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", at + 1)
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        pos = m.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i: i + 4]
            size = sum(map(len, own)) + 3
            digits = [p.lstrip("0") or "0" for p in own]
            if all(len(d) <= 3 and int(d) <= 255 for d in digits):
                out.append(("ip", pos, pos + size))
            pos += size + 1
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            d = _digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# --- the tagger -----------------------------------------------------------------------

WINDOW, STRIDE = 96, 48
HIDDEN = 16
#: 0 padding, 1-95 printable ASCII, then white space, other letters, anything else.
N_CHARS = 99
TAGS = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
N_TAGS = len(TAGS)
_NEVER = -1e4


def _char_ids(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    out = np.where((code >= 32) & (code < 127), code - 31, N_CHARS - 1)
    out[(code >= 9) & (code <= 13)] = N_CHARS - 3
    out[code >= 0xC0] = N_CHARS - 2
    return out.astype(np.int16)


def _allowed() -> np.ndarray:
    """Transition scores that are not trained: an inside tag follows only its own kind (row N_TAGS: start)."""
    m = np.zeros((N_TAGS + 1, N_TAGS), np.float32)
    for j in range(2, N_TAGS, 2):
        m[:, j] = _NEVER
        m[j - 1, j] = m[j, j] = 0
    return m


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    """Weights: character and state inputs of both directions, tag scores, transitions."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w["x" + d] = r.normal(0, 0.3, (N_CHARS, 4 * HIDDEN))
            w["x" + d][:, HIDDEN: 2 * HIDDEN] += 1  # forget gates start open
            w["h" + d] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        w["out"] = r.normal(0, 0.2, (2 * HIDDEN, N_TAGS))
        w["bias"] = np.zeros(N_TAGS)
        w["move"] = np.zeros((N_TAGS + 1, N_TAGS))
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction, shape (steps, rows, HIDDEN); ``keep`` gets what training needs."""
        n, steps = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        wx, wh = self.weights["x" + d], self.weights["h" + d]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = wx[x[:, t]] + h @ wh
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN: 2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, c_before = h, c
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, c_before, th, before))
        return out

    def _scores(self, x: np.ndarray, keep: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        states = np.concatenate(
            [self._run(x, d, None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=2
        )
        return states @ self.weights["out"] + self.weights["bias"], states

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Most likely tags of each window (Viterbi), shape of ``x``."""
        e, _ = self._scores(x)
        move = self.weights["move"] + _allowed()
        steps, n, _ = e.shape
        best = e[0] + move[N_TAGS]
        back = np.empty((steps, n, N_TAGS), np.int8)
        for t in range(1, steps):
            s = best[:, :, None] + move[None, :N_TAGS]
            back[t] = s.argmax(axis=1)
            best = s.max(axis=1) + e[t]
        tags = np.empty((n, steps), np.int8)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][rows, tags[:, t]]
        return tags

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags ``y`` and its gradients."""
        keep: dict = {}
        e, states = self._scores(x, keep)
        steps, n, _ = e.shape
        move = self.weights["move"] + _allowed()

        # forward and backward sums as probabilities, rescaled at every step
        top = e.max(axis=2, keepdims=True)
        p_e, p_move = np.exp(e - top), np.exp(move)
        fwd, bwd, scale = np.empty_like(e), np.ones_like(e), np.empty((steps, n, 1), e.dtype)
        a = p_move[N_TAGS] * p_e[0]
        for t in range(steps):
            if t:
                a = (fwd[t - 1] @ p_move[:N_TAGS]) * p_e[t]
            scale[t] = a.sum(axis=1, keepdims=True)
            fwd[t] = a / scale[t]
        for t in range(steps - 2, -1, -1):
            bwd[t] = (p_e[t + 1] * bwd[t + 1] / scale[t + 1]) @ p_move[:N_TAGS].T
        log_z = (np.log(scale) + top).sum(axis=(0, 2))
        at, rows = np.arange(steps)[:, None], np.arange(n)[None]
        gold = e[at, rows, y.T].sum(axis=0) + move[N_TAGS, y[:, 0]] + move[y[:, :-1], y[:, 1:]].sum(axis=1)
        d_e = fwd * bwd
        d_move = np.zeros_like(move)
        d_move[N_TAGS] = d_e[0].sum(axis=0)
        pairs = np.einsum("tni,tnj->ij", fwd[:-1], p_e[1:] * bwd[1:] / scale[1:], optimize=True)
        d_move[:N_TAGS] = pairs * p_move[:N_TAGS]
        np.add.at(d_move, (y[:, :-1], y[:, 1:]), -1)
        np.add.at(d_move, (np.full(n, N_TAGS), y[:, 0]), -1)
        d_e[at, rows, y.T] -= 1
        d_e /= n
        flat = d_e.reshape(-1, N_TAGS)
        grads = {"move": d_move / n, "bias": flat.sum(axis=0), "out": states.reshape(len(flat), -1).T @ flat}
        one_hot = np.zeros((steps * n, N_CHARS), e.dtype)
        one_hot[np.arange(steps * n), x.T.ravel()] = 1
        d_states = d_e @ self.weights["out"].T
        for k, d in enumerate("fb"):
            wh = self.weights["h" + d]
            gh, d_z = np.zeros_like(wh), np.empty((steps, n, 4 * HIDDEN), e.dtype)
            dh = dc = np.zeros((n, HIDDEN), np.float32)
            for t, i, f, o, g, c_before, th, before in reversed(keep[d]):
                dh = dh + d_states[t][:, k * HIDDEN: (k + 1) * HIDDEN]
                dc = dc + dh * o * (1 - th * th)
                dz = np.concatenate(
                    [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1
                )
                d_z[t] = dz
                gh += before.T @ dz
                dh, dc = dz @ wh.T, dc * f
            grads["x" + d], grads["h" + d] = one_hot.T @ d_z.reshape(steps * n, -1), gh
        return float((log_z - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 11) -> float:
        """Adam with a falling rate; the mean loss of the last epoch."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step, last = 0, []
        total = epochs * -(-len(x) // batch)
        for epoch in range(epochs):
            order = r.permutation(len(x))
            last = []
            for lo in range(0, len(x), batch):
                loss, grads = self.loss_and_gradients(x[order[lo: lo + batch]], y[order[lo: lo + batch]])
                last.append(loss)
                step += 1
                lr = rate * (1 - (step - 1) / total)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5 / max(norm, 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.weights[k] = (
                        self.weights[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
                    ).astype(np.float32)
        return float(np.mean(last)) if last else 0.0


# --- training data --------------------------------------------------------------------


def _generated(r: random.Random, kind: str) -> str:
    """A span of a kind, sometimes written in a way the patterns do not know."""

    def word(lo, hi):
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(lo, hi)))

    def number(n):
        return "".join(r.choice("0123456789") for _ in range(n))

    if kind == "email":
        local = word(3, 9) + r.choice(["", "." + word(2, 6), "." + number(2), number(2), "_" + word(2, 5)])
        host = word(3, 8) + r.choice(["", number(1), "." + word(3, 7)]) + r.choice([".com", ".org", ".net", ".de", ".fr"])
        at = r.choice(["@"] * 6 + ["(at)", "[at]", " (at) ", " @ "])
        return local + at + (host.replace(".", r.choice(["(dot)", "[dot]", "."])) if "at" in at else host)
    if kind == "ip":
        sep = r.choice([".", ".", ".", "[.]", " . "])
        return sep.join(str(r.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = r.choice("3456") + number(14)
        d = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        sep = r.choice(["", "", " ", "-", ".", "/", "  "])
        return sep.join(d[i: i + 4] for i in range(0, 16, 4))
    area, a, b = number(3), number(3), number(4)
    return r.choice([
        f"+1 ({area}) {a}-{b}", f"+{r.randint(1, 99)} {area} {a} {b}", f"({area}) {a}-{b}", f"{area}-{a}-{b}",
        f"{area}.{a}.{b}", f"00{r.randint(1, 99)} {area} {a} {b}", f"0{area}/{a}{b}", f"+{number(11)}",
    ])


def _decoy(r: random.Random) -> str:
    """Something with digits that is no personal data."""
    n = r.randint
    return r.choice([
        str(n(0, 99999)), f"{n(0, 99)}.{n(0, 9)}", f"{n(1900, 2030)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 24)}:{n(0, 59):02}",
        f"{n(1900, 2030)}", f"v{n(0, 9)}.{n(0, 20)}.{n(0, 9)}", f"{n(1, 999)},{n(0, 999):03}", "".join(r.choice("0123456789abcdef") for _ in range(14)),
        f"{n(1, 99)}%", f"{n(1900, 2030)}-{n(1900, 2030)}", f"#{n(1, 9999)}", f"{n(10**9, 10**12)}",
    ])


def _tags(spans: Iterable[Span], lo: int, n: int) -> np.ndarray:
    y = np.zeros(WINDOW, np.int64)
    for kind, s, e in spans:
        s, e = s - lo, e - lo
        if s >= 0 and e <= n:
            k = 1 + 2 * KINDS.index(kind)
            y[s] = k
            y[s + 1: e] = k + 1
    return y


def training_windows(texts: list[str], size: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``size`` windows with generated spans or decoys, and one for each pattern span of the texts (at most ``size``)."""
    r = random.Random(seed)
    texts = [t for t in texts if t] or ["the of and to in a is that for it. "]
    xs, ys = [], []

    def add(window: str, spans: list[Span], lo: int = 0) -> None:
        x = np.zeros(WINDOW, np.int16)
        ids = _char_ids(window[:WINDOW])
        x[: len(ids)] = ids
        xs.append(x)
        ys.append(_tags(spans, lo, len(ids)))

    for i in range(size):
        t = texts[i % len(texts)]
        at = r.randint(0, max(0, len(t) - WINDOW))
        context = re.sub(r"[0-9@]", "", t[at: at + WINDOW])
        if i % 5 == 0:  # a short text
            context = context[: r.randint(0, 40)]
        cut = context.find(" ", r.randint(0, max(0, len(context) - 30))) + 1
        kind = KINDS[i % 4]
        if i % 3 == 2:
            add(context[:cut] + _decoy(r) + " " + context[cut:], [])
        else:
            s = _generated(r, kind)
            tail = r.choice([" ", " ", ", ", ". ", "\n", ""])
            add(context[:cut] + s + tail + context[cut:], [(kind, cut, cut + len(s))])
    found = [(t, s) for t in texts for s in base_spans(t) if s[2] - s[1] < STRIDE]
    r.shuffle(found)
    for t, (_, s, e) in found[:size]:
        lo = max(0, s - r.randint(0, WINDOW - (e - s)))
        own = [x for x in base_spans(t[max(0, lo - WINDOW): lo + 2 * WINDOW])]
        shift = max(0, lo - WINDOW)
        add(t[lo: lo + WINDOW], [(k, a + shift, b + shift) for k, a, b in own], lo)
    return np.array(xs), np.array(ys)


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = 400, max_chars: int = 20_000,
          windows: int = 2400, epochs: int = 12) -> Tagger:
    """A tagger from labelled spans of at most ``sample`` documents of at most ``max_chars`` characters."""
    own = docs.select(F.col(id).alias("i"), F.col(text).alias("t")).where(F.length("t").between(40, max_chars))
    has_data = F.col("t").rlike("[0-9]{4}|@")
    n_data, n_all = own.agg(F.count_if(has_data), F.count("*")).first()
    rows = [
        r["t"]
        for part, n in ((own.where(has_data), n_data), (own, n_all))
        for r in least_hashed(part, "i", n, sample // 2).collect()
    ]
    tagger = Tagger.fresh()
    x, y = training_windows(rows, windows)
    tagger.fit(x, y, epochs)
    return tagger


# --- use ------------------------------------------------------------------------------


def _valid(kind: str, s: str) -> bool:
    """Is the span, with separators and written-out signs resolved, well formed?"""
    s = re.sub(r"\s*[(\[](?:at)[)\]]\s*", "@", s, flags=re.I)
    s = re.sub(r"\s*(?:[(\[]dot[)\]]|\[\.\])\s*", ".", s, flags=re.I)
    if kind == "email":
        s = re.sub(r"\s*@\s*", "@", s)
        return base_spans(s)[:1] == [("email", 0, len(s))]
    if kind == "ip":
        s = re.sub(r"\s*\.\s*", ".", s)
        return ("ip", 0, len(s)) in base_spans(s)
    d = _digits(s)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9](?:[ ./_-]{0,2}[0-9])+", s)) and 16 <= len(d) <= 19 and luhn(d)
    if ("phone", 0, len(s)) in base_spans(s):
        return True
    groups = re.findall("[0-9]+", s)
    return bool(re.fullmatch(r"[(0-9][ ()./0-9-]*[0-9]", s)) and 10 <= len(d) <= 15 and len(groups) >= 3 or (
        s.startswith("00") and 10 <= len(d) <= 15 and len(groups) >= 2 and bool(re.fullmatch(r"[ ()./0-9-]+", s)))


def _windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign."""
    out: dict[int, None] = {}
    for m in _GATE.finditer(text):
        k = m.start() // STRIDE
        for w in (k - 1, k):
            if w >= 0:
                out[w * STRIDE] = None
    return list(out)


def tag(tagger: Tagger, texts: list[str], batch: int = 512) -> list[list[Span]]:
    """Valid spans of each text that the tagger reads, reconciled over its windows."""
    jobs = [(i, lo) for i, t in enumerate(texts) for lo in _windows_of(t)]
    read: dict[int, list[tuple[int, Span]]] = {}
    for b in range(0, len(jobs), batch):
        own = jobs[b: b + batch]
        x = np.zeros((len(own), WINDOW), np.int16)
        for row, (i, lo) in enumerate(own):
            ids = _char_ids(texts[i][lo: lo + WINDOW])
            x[row, : len(ids)] = ids
        tags = tagger.decode(x)
        for row in np.flatnonzero(tags.any(axis=1)):
            i, lo = own[row]
            y = tags[row].tolist()
            n = min(WINDOW, len(texts[i]) - lo)
            p = 0
            while p < n:
                if y[p] % 2 == 0:
                    p += 1
                    continue
                e = p + 1
                while e < n and y[e] == y[p] + 1:
                    e += 1
                # context on the poorer side; the ends of the text lack none
                left = p if lo else WINDOW
                right = WINDOW - e if lo + n < len(texts[i]) else WINDOW
                read.setdefault(i, []).append((min(left, right), (KINDS[y[p] // 2], lo + p, lo + e)))
                p = e
    out: list[list[Span]] = [[] for _ in texts]
    for i, spans in read.items():
        taken: list[Span] = []  # disjoint, so only the neighbours of a span can overlap it
        starts: list[int] = []
        for _, s in sorted(set(spans), key=lambda x: (-x[0], x[1][1], x[1][2], x[1][0])):
            k = bisect_left(starts, s[2])
            if not k or taken[k - 1][2] <= s[1]:
                k = bisect_left(starts, s[1])
                starts.insert(k, s[1])
                taken.insert(k, s)
        out[i] = sorted((s for s in taken if _valid(s[0], texts[i][s[1]: s[2]])), key=_order)
    return out


def _order(s: Span) -> tuple[int, int, int]:
    return KINDS.index(s[0]), s[1], s[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_all(tagger: Tagger, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    """Pattern spans, and all spans, of each text."""
    base = [base_spans(t) for t in texts]
    more = tag(tagger, texts)
    every = []
    for b, m in zip(base, more):
        # pattern spans may overlap each other: before a place, the greatest end counts
        known = sorted((s, e) for _, s, e in b)
        starts, reach = [s for s, _ in known], list(accumulate((e for _, e in known), max))
        new = [x for x in m if not (k := bisect_left(starts, x[2])) or reach[k - 1] <= x[1]]
        every.append(sorted(b + new, key=_order) if new else b)
    return base, every


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def find(docs: DataFrame, tagger: Tagger, text: str = "text", mask: str | None = None) -> DataFrame:
    """``docs`` with ``n_email`` ... ``n_phone`` (pattern spans), ``base_sha256`` and ``spans`` added,
    and the masked text in a column named by ``mask``."""
    weights = docs.sparkSession.sparkContext.broadcast(tagger)

    def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
        col = strings(b.column(text))
        n = len(col)
        # texts without a digit or at sign have no spans of either sort
        rows = np.flatnonzero(pc.match_substring_regex(col, r"[0-9@]|[(\[][aA][tT][)\]]").to_numpy(zero_copy_only=False))
        texts = col.take(pa.array(rows)).to_pylist()
        base, every = find_all(weights.value, texts)
        counts = np.zeros((4, n), np.int64)
        digest = [hashlib.sha256(b"").hexdigest()] * n
        spans = [""] * n
        for i, own, al in zip(rows.tolist(), base, every):
            for s in own:
                counts[KINDS.index(s[0]), i] += 1
            digest[i] = hashlib.sha256(joined(own).encode()).hexdigest()
            spans[i] = joined(al)
        out = {f"n_{k}": pa.array(c) for k, c in zip(KINDS, counts)}
        out |= {"base_sha256": pa.array(digest), "spans": pa.array(spans)}
        if mask:
            new = col.to_pylist()
            for i, t, al in zip(rows.tolist(), texts, every):
                new[i] = masked(t, al) if al else t
            out[mask] = pc.if_else(b.column(text).is_valid(), pa.array(new, pa.string()), pa.scalar(None, pa.string()))
        return out

    ddl = "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string"
    return append_columns(docs, fn, ddl + (f", `{mask}` string" if mask else ""))
