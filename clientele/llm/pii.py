"""Personal data: fixed rules, and a character tagger that adds what they miss.

The tagger is a bidirectional LSTM over character classes with a conditional
random field on top, trained in numpy from labelled spans: stretches of a
bounded sample of documents, labelled by the rules, and disguised copies of
them. A personal item of the four kinds has a digit or an at sign, so stretches
around these are cut into overlapping windows; windows are decoded one by one,
and their spans are reconciled over the whole text: pieces of one span are
joined, and among spans that conflict the one further from its window's edge
stays. A span of the tagger counts if it has the form of its kind and touches
no span of the rules.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import giving_back

# fixed values: kinds in their order, and the patterns of the rules
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs so that long runs cost no more than their length."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """What the rules find, by start, then kind."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        # zeros in front may be any number
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group()) if m.end() - m.start() < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- the forms a span of the tagger must have --------------------------------

_AT, _DOT = r"\s?(?:@|\(at\)|\[at\])\s?", r"\s?(?:\.|\(dot\)|\[dot\])\s?"
_AT_FIRST, _WORD = re.compile(_AT), re.compile(r"[\w-]*", re.ASCII)
_FORMS = (
    re.compile(rf"[\w.%+-]+{_AT}[\w-]+(?:{_DOT}[\w-]+)+", re.ASCII),
    re.compile(r"\d{1,3}(?:(?:\.|\[\.\])\d{1,3}){3}", re.ASCII),
    re.compile(r"\d(?:[ .-]?\d){12,18}", re.ASCII),
    re.compile(r"\+?\(?\d+(?:[ ().-]{1,2}\d+){2,5}", re.ASCII),
)


def well_formed(kind: int, text: str) -> bool:
    if not _FORMS[kind].fullmatch(text):
        return False
    if kind == 1:
        return all(int(p) <= 255 for p in re.findall(r"\d+", text))
    if kind == 2:
        return luhn(digits_of(text))
    return kind != 3 or 10 <= len(digits_of(text)) <= 15


# --- windows -----------------------------------------------------------------

LENGTH, STRIDE = 48, 24
#: Characters around a digit or at sign that are decoded.
MARGIN = 12
SEEDS = re.compile(r"[0-9@]|[(\[]at[)\]]")
#: What may follow the at of an e-mail.
_REST = re.compile(rf"\s?[\w-]+(?:{_DOT}[\w-]+)*", re.ASCII)

_CLASSES = "\0@.+-()[]%_:=\"' \n,;/"
CLASS = {c: i for i, c in enumerate(_CLASSES)}
DIGIT, LOWER, UPPER, WIDE, REST = range(len(_CLASSES), len(_CLASSES) + 5)
CLASS_COUNT = REST + 1
_TABLE = np.full(128, REST, np.int64)
for _c, _i in CLASS.items():
    _TABLE[ord(_c)] = _i
_TABLE[48:58], _TABLE[97:123], _TABLE[65:91] = DIGIT, LOWER, UPPER


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, _TABLE[np.minimum(points, 127)], WIDE)


def local_start(text: str, at: int) -> int:
    """Where the run of local-part characters that ends at ``at`` begins."""
    while at > 0 and text[at - 1] in LOCAL:
        at -= 1
    return at


def regions(text: str, whole: bool = True) -> list[tuple[int, int]]:
    """The stretches around seeds, joined where they meet.

    With ``whole`` a stretch around an at has the whole local part before it and
    what may be a domain after it.
    """
    out: list[list[int]] = []
    for m in SEEDS.finditer(text):
        a, b = m.start(), m.end()
        if whole and not "0" <= text[a] <= "9":
            rest = _REST.match(text, b)
            a, b = local_start(text, a - (a > 0 and text[a - 1].isspace())), rest.end() if rest else b
        a, b = max(0, a - MARGIN), min(len(text), b + MARGIN)
        while out and a <= out[-1][1]:
            start, stop = out.pop()
            a, b = min(a, start), max(b, stop)
        out.append([a, b])
    return [(a, b) for a, b in out]


def window_starts(start: int, stop: int) -> list[int]:
    """Overlapping windows that cover a stretch."""
    starts = list(range(start, max(start + 1, stop - LENGTH + STRIDE), STRIDE))
    return starts


# --- the model -----------------------------------------------------------------

LABELS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
HIDDEN = 16
STEPS, BATCH, RATE = 140, 96, 0.02
SEED = 5
#: Documents and windows of the training sample.
SAMPLE, SAMPLE_WINDOWS = 8000, 2400
#: Stretches of a sampled document, and characters of one, that the sample takes at most.
PER_DOCUMENT, LONGEST = 8, 4 * LENGTH


@dataclass(frozen=True)
class Tagger:
    """Weights: inputs and recurrence of both directions, output, transitions."""

    inputs: np.ndarray  # 2, classes, 4 x hidden
    recurrent: np.ndarray  # 2, hidden, 4 x hidden
    output: np.ndarray  # 2 x hidden, labels
    bias: np.ndarray
    transitions: np.ndarray  # labels, labels
    first: np.ndarray

    NAMES = ("inputs", "recurrent", "output", "bias", "transitions", "first")

    @staticmethod
    def start() -> Tagger:
        rng = np.random.default_rng(SEED)
        inputs = rng.normal(0, 0.3, (2, CLASS_COUNT, 4 * HIDDEN))
        inputs[:, :, HIDDEN : 2 * HIDDEN] += 0.7  # forget little at first
        return Tagger(
            inputs,
            rng.normal(0, 0.25, (2, HIDDEN, 4 * HIDDEN)),
            rng.normal(0, 0.2, (2 * HIDDEN, LABELS)),
            np.zeros(LABELS),
            np.where(allowed(), 0.0, -4.0),
            np.where(np.arange(LABELS) % 2 == 0, np.where(np.arange(LABELS) == 0, 0.0, -4.0), 0.0),
        )

    def states(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Both directions at once over windows ``x`` (windows, length)."""
        both = np.stack([x, x[:, ::-1]])
        fed = np.stack([self.inputs[d][both[d].T] for d in (0, 1)], axis=1)  # length, 2, windows, 4 h
        length, _, n, _ = fed.shape
        shape = (length + 1, 2, n, HIDDEN)
        h, c = np.zeros(shape), np.zeros(shape)
        gates, squashed = np.empty((length, 2, n, 4 * HIDDEN)), np.empty((length, 2, n, HIDDEN))
        for t in range(length):
            z = fed[t] + h[t] @ self.recurrent
            gates[t, ..., : 3 * HIDDEN] = 0.5 + 0.5 * np.tanh(0.5 * z[..., : 3 * HIDDEN])
            gates[t, ..., 3 * HIDDEN :] = np.tanh(z[..., 3 * HIDDEN :])
            i, f, o, g = np.split(gates[t], 4, axis=-1)
            c[t + 1] = f * c[t] + i * g
            squashed[t] = np.tanh(c[t + 1])
            h[t + 1] = o * squashed[t]
        top = np.concatenate([h[1:, 0], h[:0:-1, 1]], axis=-1)  # length, windows, 2 h
        return {"x": both, "h": h, "c": c, "gates": gates, "squashed": squashed, "top": top}

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.states(x)["top"] @ self.output + self.bias

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best labels of each window under the transitions that spans allow."""
        emitted = self.emissions(x)
        moves = np.where(allowed(), self.transitions, -1e6)
        best = emitted[0] + np.where(np.arange(LABELS) % 2 == 0, np.where(np.arange(LABELS) == 0, self.first, -1e6), self.first)
        came = np.empty((len(emitted), x.shape[0], LABELS), np.int8)
        for t in range(1, len(emitted)):
            reached = best[:, :, None] + moves[None]
            came[t] = reached.argmax(axis=1)
            best = reached.max(axis=1) + emitted[t]
        labels = np.empty(x.shape, np.int64)
        labels[:, -1] = best.argmax(axis=1)
        for t in range(len(emitted) - 1, 0, -1):
            labels[:, t - 1] = came[t][np.arange(len(x)), labels[:, t]]
        return labels

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood per window, and its gradients."""
        s = self.states(x)
        emitted = s["top"] @ self.output + self.bias
        length, n, _ = emitted.shape
        alpha, beta = np.empty_like(emitted), np.zeros_like(emitted)
        alpha[0] = emitted[0] + self.first
        for t in range(1, length):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + self.transitions[None], 1) + emitted[t]
        for t in range(length - 2, -1, -1):
            beta[t] = _log_sum(self.transitions[None] + (emitted[t + 1] + beta[t + 1])[:, None], 2)
        total = _log_sum(alpha[-1], 1)
        truth = np.eye(LABELS)[y.T]
        d_emitted = (np.exp(alpha + beta - total[:, None]) - truth) / n
        pair = np.exp(
            alpha[:-1, :, :, None]
            + self.transitions
            + (emitted[1:] + beta[1:])[:, :, None, :]
            - total[:, None, None]
        ).sum(axis=(0, 1))
        counted = np.zeros((LABELS, LABELS))
        np.add.at(counted, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        gold = (emitted * truth).sum(axis=(0, 2)) + self.first[y[:, 0]]
        gold = gold + self.transitions[y[:, :-1], y[:, 1:]].sum(axis=1)
        out = {
            "transitions": (pair - counted) / n,
            "first": d_emitted[0].sum(axis=0),
            "bias": d_emitted.sum(axis=(0, 1)),
            "output": np.einsum("tnh,tnk->hk", s["top"], d_emitted, optimize=True),
        }
        d_top = d_emitted @ self.output.T
        d_h = np.stack([d_top[..., :HIDDEN], d_top[::-1, :, HIDDEN:]], axis=1)
        d_z = np.empty_like(s["gates"])
        carry_h, carry_c = np.zeros((2, n, HIDDEN)), np.zeros((2, n, HIDDEN))
        turned = self.recurrent.transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            i, f, o, g = np.split(s["gates"][t], 4, axis=-1)
            dh = d_h[t] + carry_h
            dc = carry_c + dh * o * (1 - s["squashed"][t] ** 2)
            d_z[t] = np.concatenate(
                [dc * g * i * (1 - i), dc * s["c"][t] * f * (1 - f), dh * s["squashed"][t] * o * (1 - o), dc * i * (1 - g**2)],
                axis=-1,
            )
            carry_h, carry_c = d_z[t] @ turned, dc * f
        out["recurrent"] = np.einsum("tdnh,tdnk->dhk", s["h"][:-1], d_z, optimize=True)
        out["inputs"] = np.zeros_like(self.inputs)
        for d in (0, 1):
            np.add.at(out["inputs"][d], s["x"][d].T.ravel(), d_z[:, d].reshape(-1, 4 * HIDDEN))
        return float((total - gold).mean()), out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def allowed() -> np.ndarray:
    """Which label may follow which: inside only after begin or inside of its kind."""
    label = np.arange(LABELS)
    inside = (label % 2 == 0) & (label > 0)
    same = (label[:, None] + 1) // 2 == (label[None] + 1) // 2
    return ~inside[None] | same & (label[:, None] > 0)


def train(windows: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Tagger:
    """Adam on batches of labelled windows, the same for the same windows."""
    tagger, rng = Tagger.start(), np.random.default_rng(SEED)
    if not len(windows):
        return tagger
    mean = {k: np.zeros_like(getattr(tagger, k)) for k in Tagger.NAMES}
    square = {k: np.zeros_like(v) for k, v in mean.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(windows), BATCH)
        _, slope = tagger.loss_and_gradients(windows[at], labels[at])
        length = np.sqrt(sum(np.square(v).sum() for v in slope.values()))
        new = {}
        for k, v in slope.items():
            v = v * min(1.0, 5.0 / max(length, 1e-12))
            mean[k] = 0.9 * mean[k] + 0.1 * v
            square[k] = 0.99 * square[k] + 0.01 * v * v
            pace = RATE * (1 - 0.8 * step / steps)
            new[k] = getattr(tagger, k) - pace * (mean[k] / (1 - 0.9**step)) / (
                np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
            )
        tagger = replace(tagger, **new)
    return tagger


# --- labelled spans --------------------------------------------------------------

def label_window(start: int, spans: Sequence[Span]) -> np.ndarray:
    """Labels of the window at ``start``; what begins before it is inside from its first character."""
    out = np.zeros(LENGTH, np.int64)
    for a, kind, b in spans:
        if a >= start + LENGTH or b <= start:
            continue
        out[max(a - start, 0) : b - start] = 2 + 2 * kind
        out[max(a - start, 0)] = 1 + 2 * kind
    return out


def cut(text: str, start: int) -> np.ndarray:
    part = classes(text[start : start + LENGTH])
    return np.pad(part, (0, LENGTH - len(part)))


def disguised(item: str, kind: int, rng: np.random.Generator) -> str:
    """Another way to write an item of a kind."""
    if kind == 0:
        at, dot = (("(at)", "."), ("[at]", "."), (" (at) ", "."), ("(at)", "(dot)"), ("[at]", "[dot]"))[int(rng.integers(5))]
        name, _, domain = item.partition("@")
        return name + at + domain.replace(".", dot)
    if kind == 1:
        return item.replace(".", "[.]")
    digits = digits_of(item)
    if kind == 2:
        return (" ", "-", ".")[int(rng.integers(3))].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    core = digits[-10:]
    forms = (f"({core[:3]}) {core[3:6]}-{core[6:]}", f"{core[:3]}-{core[3:6]}-{core[6:]}", f"{core[:3]}.{core[3:6]}.{core[6:]}")
    return forms[int(rng.integers(3))]


def examples(parts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows from stretches of text: as they are, and with their items disguised."""
    rng = np.random.default_rng(SEED)
    windows, labels = [], []
    for text in parts:
        spans = base_spans(text)
        first = int(rng.integers(0, max(1, min(len(text), LENGTH) // 2)))
        windows.append(cut(text, first))
        labels.append(label_window(first, spans))
        if spans:
            start, kind, end = spans[int(rng.integers(len(spans)))]
            other = disguised(text[start:end], kind, rng)
            changed = text[:start] + other + text[end:]
            first = max(0, start - int(rng.integers(2, 16)))
            windows.append(cut(changed, first))
            labels.append(label_window(first, [(start, kind, start + len(other))]))
    if not windows:
        return np.zeros((0, LENGTH), np.int64), np.zeros((0, LENGTH), np.int64)
    return np.stack(windows), np.stack(labels)


def stretches(text: str, most: int = PER_DOCUMENT, longest: int = LONGEST) -> list[str]:
    """Up to ``most`` stretches with seeds of at most ``longest`` characters, drawn by their hash."""
    found = [text[max(0, a - STRIDE) : b + STRIDE] for a, b in regions(text, whole=False) if b - a <= longest]
    return sorted(found, key=lambda s: (zlib.crc32(s.encode("utf-8", "surrogatepass")), s))[:most]


def sample_stretches(docs: DataFrame, documents: int = SAMPLE, windows: int = SAMPLE_WINDOWS) -> list[str]:
    """Stretches with seeds from about ``documents`` documents, ``windows`` of them at most.

    Documents are drawn by a hash of id and text among those with a digit or at
    sign, and of each at most ``PER_DOCUMENT`` stretches of at most ``LONGEST``
    characters, by their own hash; this bounded sample is all the tagger is
    trained on.
    """
    seeded = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    total = docs.count()
    if not total:
        return []
    drawn = seeded.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, total))) < documents)

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [p for t in batch["text"] for p in stretches(t)]
            yield pd.DataFrame({"part": parts}, dtype=object)

    rows = drawn.select("text").mapInPandas(giving_back(cut_out), "part string")
    kept = rows.orderBy(F.xxhash64("part"), "part").limit(windows).collect()
    return [r["part"] for r in kept]


def train_on(docs: DataFrame) -> Tagger:
    return train(*examples(sample_stretches(docs)))


# --- tagging ------------------------------------------------------------------------

@dataclass(frozen=True)
class Found:
    """A span, whether the rules found it, and where it lies in its window."""

    start: int
    kind: int
    end: int
    base: bool


def read_labels(labels: np.ndarray, start: int) -> list[tuple[Span, int]]:
    """Spans of one decoded window and how far each is from the window's edges."""
    out, at = [], 0
    while at < LENGTH:
        if labels[at] == 0:
            at += 1
            continue
        kind, end = (labels[at] - 1) // 2, at + 1
        while end < LENGTH and labels[end] == 2 + 2 * kind:
            end += 1
        out.append(((start + at, int(kind), start + end), min(at, LENGTH - end)))
        at = end
    return out


def reconcile(windows: list[tuple[Span, int]]) -> list[Span]:
    """Spans over a whole text from those of its windows.

    Overlapping spans of one kind are joined if either runs into its window's
    edge. Of spans that still conflict the one further from the edge stays,
    then the longer, then the earlier.
    """
    joined: list[tuple[Span, int]] = []
    for span, edge in sorted(windows):
        if joined:
            (a, kind, b), before = joined[-1]
            if kind == span[1] and span[0] < b and (before == 0 or edge == 0):
                joined[-1] = ((a, kind, max(b, span[2])), max(before, edge))
                continue
        joined.append((span, edge))
    kept: list[Span] = []
    for (a, kind, b), _ in sorted(joined, key=lambda w: (-w[1], w[0][0] - w[0][2], w[0])):
        if all(b <= x or y <= a for x, _, y in kept):
            kept.append((a, kind, b))
    return sorted(kept)


def tag(texts: Sequence[str | None], tagger: Tagger, block: int = 512) -> list[list[Found]]:
    """All spans of each text, by start, then kind."""
    places: list[tuple[int, int]] = []
    decoded: list[list[tuple[Span, int]]] = [[] for _ in texts]

    def run() -> None:
        x = np.stack([cut(texts[i], s) for i, s in places])
        for (i, s), labels in zip(places, tagger.decode(x)):
            if labels.any():
                size = len(texts[i])
                decoded[i] += [w for w in read_labels(labels, s) if w[0][2] <= size]
        places.clear()

    for i, text in enumerate(texts):
        for a, b in regions(text or ""):
            for s in window_starts(a, b):
                places.append((i, s))
                if len(places) >= block:
                    run()
    if places:
        run()
    out = []
    for text, found in zip(texts, decoded):
        text = text or ""
        base = base_spans(text)
        starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
        added = [
            s
            for s in _whole_emails(text, _by_region(found))
            if well_formed(s[1], text[s[0] : s[2]]) and not _touches(s, starts, reach)
        ]
        spans = [Found(a, k, b, True) for a, k, b in base] + [Found(a, k, b, False) for a, k, b in added]
        out.append(sorted(spans, key=lambda f: (f.start, f.kind, f.end)))
    return out


def _by_region(found: list[tuple[Span, int]]) -> list[Span]:
    """Reconcile runs of overlapping spans one after the other."""
    out: list[Span] = []
    run: list[tuple[Span, int]] = []
    reach = -1
    for w in sorted(found):
        if run and w[0][0] >= reach:
            out += reconcile(run)
            run = []
        run.append(w)
        reach = max(reach, w[0][2])
    return out + (reconcile(run) if run else [])


def _whole_emails(text: str, spans: list[Span]) -> list[Span]:
    """E-mails that begin or end inside a word, or at their at, taken to its ends if that has their form.

    Of spans that then meet the first stays.
    """
    out: list[Span] = []
    tried = 0  # a run is walked once
    for a, kind, b in spans:
        if out and a < out[-1][2]:
            continue
        if kind == 0:
            if a < tried:
                continue
            if _AT_FIRST.match(text, a):
                a -= a > 0 and text[a - 1].isspace()
            a = max(local_start(text, a), out[-1][2] if out else 0)
            tried = b = _WORD.match(text, b).end()
            if not well_formed(kind, text[a:b]):
                continue
        out.append((a, kind, b))
    return out


def _touches(span: Span, starts: list[int], reach: list[int]) -> bool:
    """Whether a span overlaps one of the rules'; ``reach`` is how far all up to each one come."""
    at = bisect_left(starts, span[2])
    return at > 0 and reach[at - 1] > span[0]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def personal_data(text: Column, tagger: Tagger) -> Column:
    """All spans of each whole text; a null text has none."""

    @F.pandas_udf(SPANS)
    @giving_back
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = tag(list(texts), tagger)
            yield pd.Series(
                [[{"kind": KINDS[f.kind], "start": f.start, "end": f.end, "base": f.base} for f in one] for one in found],
                dtype=object,
            )

    return spans(text)


def redacted(text: Column, tagger: Tagger) -> Column:
    """The text with each span (or run of overlapping spans) replaced by its kind in brackets; null stays null."""

    @F.pandas_udf("string")
    @giving_back
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = tag(list(texts), tagger)
            yield pd.Series([_replaced(t, f) for t, f in zip(texts, found)], dtype=object)

    return cleaned(text)


def _replaced(text: str | None, spans: list[Found]) -> str | None:
    if text is None or not spans:
        return text
    out, at = [], 0
    for f in spans:
        if f.start >= at:
            out += [text[at : f.start], f"[{KINDS[f.kind].upper()}]"]
        at = max(at, f.end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted again.

    Without a tagger one is trained on a sample of ``docs``. Other columns and
    rows stay as they are; ``n_chars`` of a null text is as it was.
    """
    tagger = tagger or train_on(docs)
    cleaned = docs.withColumn("text", redacted(F.col("text"), tagger))
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    counted = F.coalesce(F.length("text").cast(kind), F.col("n_chars"))
    return cleaned.withColumn("n_chars", counted)
