"""Personal data: base patterns, and spans that a character model adds.

The model is a bidirectional LSTM over characters whose outputs a CRF decodes into
B/I/O tags of the four kinds. It is trained in numpy on generated texts with
labelled spans. Texts are cut into windows of ``WINDOW`` characters, each half
covered by the next; every character takes its tag from the window in which it lies
nearest the middle, so that spans are put together over the whole text.

A span counts only if it has a digit, an @ or a bracketed "at". So decoding begins with
the windows whose middle part has one, and goes on to a neighbour wherever a tag of a kind
stands at the edge of a middle part, until none does. Every such span is then tagged as if
all windows had been decoded; windows left out can hold none. A span of the model is widened
to whole words and counts if what is written in it can be of its kind (``accepted``: right
numbers of digits, Luhn, parts to 255, a name and a host, ``LONGEST`` characters) and it overlaps no base span.
The model tells where a span is and of which kind; these checks only refuse.

Cases: a null or empty text has no spans; a text of any length is read whole, in
memory in proportion to it, and each pattern takes time in proportion to it; repeated
rows get the same result; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrow import slices, utf8
from .scratch import documents, shipped

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
HIDDEN, EMBED, SYMBOLS = 24, 12, 130
STEPS, BATCH = 800, 64

# -- base patterns: fixed by the contract ----------------------------------
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def _card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str) -> bool:
    return 10 <= len(NOT_DIGIT.sub("", text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: before an @ the whole run of local characters, up to the match before."""
    end = at = 0
    while (at := text.find("@", max(at, end))) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at += 1


def base_spans(text: str) -> list[Span]:
    out = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern, good in ((1, IP, _small_parts), (2, CARD, _card), (3, PHONE, _phone)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if good(m[0])]
    return sorted(out)


# -- the model ----------------------------------------------------------------
def symbols(text: str) -> np.ndarray:
    """ASCII as it is, one number for other letters and one for the rest."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(code < 128, code, 128).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Parameters, forward pass, decoding and training; arrays are (time, batch, ...)."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        new = lambda *s: (draw.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"e": new(SYMBOLS, EMBED), "o": new(2 * HIDDEN, TAGS), "ob": np.zeros(TAGS, np.float32), "t": np.zeros((TAGS, TAGS), np.float32), "s": np.zeros(TAGS, np.float32)}
        for d in "fb":
            self.p |= {f"{d}x": new(EMBED, 4 * HIDDEN), f"{d}h": new(HIDDEN, 4 * HIDDEN), f"{d}b": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"{d}b"][HIDDEN : 2 * HIDDEN] = 1

    def lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        p, n = self.p, HIDDEN
        gx = x @ p[f"{d}x"] + p[f"{d}b"]
        h = c = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((*x.shape[:2], n), np.float32)
        for t in range(len(x)):
            z = gx[t] + h @ p[f"{d}h"]
            s, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep is not None:
                keep.append((h, before, i, f, o, g, tc))
            h = o * tc
            out[t] = h
        return out

    def lstm_back(self, x: np.ndarray, d: str, kept: list, gout: np.ndarray, grads: dict) -> np.ndarray:
        p, n = self.p, HIDDEN
        gz = np.empty((*x.shape[:2], 4 * n), np.float32)
        gh = gc = np.zeros((x.shape[1], n), np.float32)
        for t in reversed(range(len(x))):
            h, before, i, f, o, g, tc = kept[t]
            gh = gh + gout[t]
            gc = gc + gh * o * (1 - tc * tc)
            gz[t] = np.concatenate((gc * g * i * (1 - i), gc * before * f * (1 - f), gh * tc * o * (1 - o), gc * i * (1 - g * g)), axis=1)
            grads[f"{d}h"] += h.T @ gz[t]
            gh, gc = gz[t] @ p[f"{d}h"].T, gc * f
        grads[f"{d}x"] += np.tensordot(x, gz, ((0, 1), (0, 1)))
        grads[f"{d}b"] += gz.sum(axis=(0, 1))
        return gz @ p[f"{d}x"].T

    def emissions(self, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        x = self.p["e"][ids]
        kf, kb = ([], []) if keep is not None else (None, None)
        both = np.concatenate((self.lstm(x, "f", kf), self.lstm(x[::-1], "b", kb)[::-1]), axis=2)
        if keep is not None:
            keep |= {"x": x, "kf": kf, "kb": kb, "both": both}
        return both @ self.p["o"] + self.p["ob"]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tags by Viterbi, (time, batch)."""
        e, t = self.emissions(ids), self.p["t"]
        score, back = e[0] + self.p["s"], []
        for k in range(1, len(e)):
            ways = score[:, :, None] + t[None]
            back.append(ways.argmax(axis=1))
            score = ways.max(axis=1) + e[k]
        tags = [score.argmax(axis=1)]
        for b in reversed(back):
            tags.append(b[np.arange(len(tags[-1])), tags[-1]])
        return np.stack(tags[::-1])

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> dict:
        """Of the CRF's negative log-likelihood, a mean over the batch."""
        keep: dict = {}
        e, t = self.emissions(ids, keep), self.p["t"]
        n, size = e.shape[:2]
        lse = lambda v, axis: (m := v.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis=axis))
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0] + self.p["s"]
        for k in range(1, n):
            a[k] = lse(a[k - 1][:, :, None] + t, 1) + e[k]
        for k in reversed(range(n - 1)):
            b[k] = lse((b[k + 1] + e[k + 1])[:, None, :] + t, 2)
        z = lse(a[-1], 1)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        ge = np.exp(a + b - z[None, :, None])
        for k in range(n - 1):
            grads["t"] += np.exp(a[k][:, :, None] + t + (b[k + 1] + e[k + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.add.at(grads["t"], (tags[:-1].ravel(), tags[1:].ravel()), -1)
        ge[np.arange(n)[:, None], np.arange(size)[None], tags] -= 1
        grads["s"] += ge[0].sum(axis=0)
        grads["o"] += np.tensordot(keep["both"], ge, ((0, 1), (0, 1)))
        grads["ob"] += ge.sum(axis=(0, 1))
        gb = ge @ self.p["o"].T
        gx = self.lstm_back(keep["x"], "f", keep["kf"], gb[:, :, :HIDDEN], grads)
        gx = gx + self.lstm_back(keep["x"][::-1], "b", keep["kb"], gb[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["e"], ids, gx)
        return {k: v / size for k, v in grads.items()}

    def fit(self, steps: int, batch: int, seed: int) -> Tagger:
        draw = random.Random(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            pairs = [example(draw) for _ in range(batch)]
            g = self.gradients(np.stack([symbols(x) for x, _ in pairs], 1), np.array([y for _, y in pairs]).T)
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            rate = 0.02 * (1 - step / (steps + 1)) + 0.001
            for k, x in g.items():
                x = x * min(1, 5 / norm)
                m[k], v[k] = 0.9 * m[k] + 0.1 * x, 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)
        return self


# -- labelled spans ---------------------------------------------------------------
SYLLABLES = "an be ca de el fi go hu in jo ka le mi no or pa qui ra se ti un va wo xe ya zu che ght tion ment schen ß é ü ñ ó ng st tr".split()
COMMON = "the and of to a in for is on that by with from at as it be are was or an you we not have this but now ok end see all out order page version total room de la el que le les des et der die das und ist nicht den von".split()
LEADS = ("call", "phone", "tel", "Tel.:", "fax:", "mobile", "mail", "e-mail:", "contact", "write to", "card", "card no.", "pay with", "server", "host", "address", "from", "IP", "reach me at")
HEX = "0123456789abcdef"


def _word(r: random.Random) -> str:
    u = r.random()
    w = r.choice(COMMON) if u < 0.45 else "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) if u < 0.8 else "".join(r.choice("etaoinshrdlcumwfgypbvkéèüößñóí") for _ in range(r.randint(1, 11)))
    return (w.capitalize() if r.random() < 0.2 else w.upper() if r.random() < 0.05 else w) + r.choice(["", "", "", "", "", "", ".", ",", ":", "!!", "###", "%%%", "$$$", "&&&"])


def _digits(r: random.Random, n: int) -> str:
    """Any digits, or now and then few different ones."""
    some = "0123456789" if r.random() < 0.8 else [r.choice("0123456789") for _ in range(2)]
    return "".join(r.choice(some) for _ in range(n))


def _other_number(r: random.Random) -> str:
    year, month, day = r.randint(1900, 2030), r.randint(1, 12), r.randint(1, 28)
    return r.choice([
        lambda: _digits(r, r.randint(1, 13)), lambda: f"{_digits(r, r.randint(1, 4))}.{_digits(r, r.randint(1, 6))}", lambda: "".join(r.choice(HEX) for _ in range(r.randint(8, 44))),
        lambda: f"{year}{r.choice('-/.')}{month:02}{r.choice('-/.')}{day:02}", lambda: f"{day}.{month}.{year}", lambda: f"{day:02}/{month:02}/{year} {r.randint(0, 23):02}:{r.randint(0, 59):02}",
        lambda: f"{r.randint(0, 23):02}:{r.randint(0, 59):02}:{r.randint(0, 59):02}", lambda: f"{r.choice(['v', '', 'version '])}{r.randint(0, 20)}.{r.randint(0, 20)}.{r.randint(0, 99)}", lambda: f"@{_word(r)}",
        lambda: f"{r.randint(1, 99)} @ {r.randint(1, 99)}", lambda: ",".join([_digits(r, 2), *(_digits(r, 3) for _ in range(r.randint(1, 4)))]), lambda: f"{year}-{year + r.randint(1, 9)}",
        lambda: f'token = "{_digits(r, 2)}{"".join(r.choice(HEX) for _ in range(30))}"', lambda: _digits(r, r.randint(20, 30)), lambda: " ".join(_digits(r, r.randint(1, 3)) for _ in range(r.randint(2, 3))),
        lambda: f"${_digits(r, 2)},{_digits(r, 3)}.{_digits(r, 2)}", lambda: f"(at {_digits(r, 2)} {_word(r)})", lambda: f"[{_digits(r, 1)}]", lambda: f"{_digits(r, 2)}-{_digits(r, 3)}",
    ])()


def _name(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES[:27]) for _ in range(r.randint(1, 4))) if r.random() < 0.7 else "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))


def _personal(r: random.Random, kind: int) -> str:
    if kind == 0:
        local = _name(r) + r.choice(["", "." + _name(r), "." + _name(r), _digits(r, 2), "_" + _name(r), "." + _digits(r, 2)])
        at, dot = r.choice(["@", "@", " @ ", "(at)", " (at) ", "[at]", " [at] "]), r.choice([".", ".", ".", "(dot)", " (dot) ", "[dot]"])
        return local + at + _name(r) + r.choice(["", "", _digits(r, 1), "-" + _name(r), "." + _name(r)]) + dot + r.choice(["com", "org", "net", "example", "de", "co.uk", _name(r)])
    if kind == 1:
        return r.choice([".", ".", " .", ". ", " . ", "[.]", "(.)"]).join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        cuts = r.choice([(4, 4, 4, 4), (4, 4, 4, 4), (4, 6, 5), (4, 4, 4, 4, 3), (6, 8), (4, 4, 4, 2)])
        return r.choice(["", " ", "-", ".", "  ", "_", " - "]).join(_digits(r, n) for n in cuts)
    a, b, c, land = _digits(r, 3), _digits(r, 3), _digits(r, 4), r.randint(1, 99)
    s = r.choice(["-", "-", " ", "."])
    first = r.choice([f"({a}) {b}{s}{c}", f"({a}){b}{s}{c}", f"{a}{s}{b}{s}{c}", f"{a}/{b}-{c}", f"1{s}{a}{s}{b}{s}{c}", f"{a}{s}{b}{s}{c}", f"0{_digits(r, r.randint(2, 4))}{r.choice(' /-')}{_digits(r, r.randint(6, 8))}"])
    abroad = r.choice(["+", "00"]) + str(land) + r.choice([f" ({a}) {b}-{c}", f" {a} {b} {c}", f" {_digits(r, 2)} {c} {_digits(r, 4)}", f"-{a}-{b}-{c}", f" {_digits(r, 4)} {_digits(r, 6)}"])
    return first if r.random() < 0.6 else abroad


def example(r: random.Random) -> tuple[str, list[int]]:
    """A window of text and the tag of each of its characters; spans may be cut off at either end."""
    text, tags = "", []
    while len(text) < 2 * WINDOW:
        u = r.random()
        kind = r.choice((0, 1, 2, 2, 3, 3)) if u < 0.25 else -1
        if kind >= 0 and r.random() < 0.4:
            lead = r.choice(LEADS) + " "
            text, tags = text + lead, tags + [0] * len(lead)
        piece = _personal(r, kind) if kind >= 0 else _other_number(r) if u < 0.38 else _word(r)
        tags += [0] * len(piece) if kind < 0 else [1 + 2 * kind] + [2 + 2 * kind] * (len(piece) - 1)
        after = r.choice([" ", " ", " ", " ", "\n", ". ", ", ", "### ", "!! "])
        text += piece + after
        tags += [0] * len(after)
    at = r.randint(0, WINDOW // 2)
    return text[at : at + WINDOW], tags[at : at + WINDOW]


@lru_cache(2)
def tagger(steps: int = STEPS, batch: int = BATCH, seed: int = 5) -> Tagger:
    return Tagger(seed).fit(steps, batch, seed)


# -- whole texts ---------------------------------------------------------------------
def _signs(code: np.ndarray) -> np.ndarray:
    """Where a span that counts may be: digits, @, and brackets before "at"."""
    out = ((code >= 48) & (code <= 57)) | (code == 64)
    out[:-2] |= ((code[:-2] == 40) | (code[:-2] == 91)) & ((code[1:-1] | 32) == 97) & ((code[2:] | 32) == 116)
    return out


def tag_texts(model: Tagger, texts: list[str], batch: int = 1024, *, everything: bool = False) -> list[list[Span]]:
    """Spans by the model of each text, from its windows together: those that a span with a digit or an @ may touch, or all."""
    sizes = np.array(list(map(len, texts)), np.int64)
    base = np.concatenate(([0], np.cumsum(sizes + WINDOW)))
    flat = np.full(base[-1], SYMBOLS - 1, np.uint8)
    for t, a, n in zip(texts, base, sizes):
        flat[a : a + n] = symbols(t)
    # Window k of a text begins at k * STRIDE; its middle part is what lies nearer its middle than any other window's.
    last = np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    first = np.concatenate(([0], np.cumsum(last + 1)))
    of = np.repeat(np.arange(len(texts)), last + 1)
    k = np.arange(first[-1]) - first[of]
    start, edge = base[of] + k * STRIDE, (WINDOW - STRIDE) // 2
    begin, end = np.where(k > 0, start + edge, start), np.where(k < last[of], start + edge + STRIDE, base[of] + sizes[of])
    if everything:
        todo = np.arange(first[-1])
    else:
        spots = np.flatnonzero(_signs(flat))
        which = np.searchsorted(base, spots, side="right") - 1
        todo = np.unique(first[which] + np.clip((spots - base[which] - edge) // STRIDE, 0, last[which]))
    tags, done, inside = np.zeros(len(flat), np.int8), np.zeros(first[-1], bool), np.arange(WINDOW)[:, None]
    while len(todo):
        for at in range(0, len(todo), batch):
            part = todo[at : at + batch]
            place = start[part] + inside
            found = model.decode(flat[place].astype(np.int64))
            mine = (place >= begin[part]) & (place < end[part])
            tags[place[mine]] = found[mine]
        done[todo] = True
        some = todo[end[todo] > begin[todo]]
        left, right = some[(k[some] > 0) & (tags[begin[some]] > 0)] - 1, some[(k[some] < last[of[some]]) & (tags[end[some] - 1] > 0)] + 1
        todo = np.unique(np.concatenate((left, right)))
        todo = todo[~done[todo]]
    return [list(_spans(tags[a : a + n])) if n else [] for a, n in zip(base, sizes)]


def _spans(tags: np.ndarray) -> Iterator[Span]:
    at = 0
    kinds = (tags.astype(np.int64) + 1) // 2  # 0 is none
    for end in [*(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist(), len(kinds)]:
        if end > at and kinds[at]:
            starts = [at, *(k for k in range(at + 1, end) if tags[k] == 2 * kinds[at] - 1), end]
            yield from ((a, int(kinds[at]) - 1, b) for a, b in zip(starts, starts[1:]))
        at = end


LONGEST = 256  # characters of a span that the model may add
AT, DOT = re.compile(r"\s*(?:@|[(\[][aA][tT][)\]])\s*"), re.compile(r"\s*[(\[][dD][oO][tT][)\]]\s*")
BETWEEN = (None, re.compile(r"[ .()\[\]]+"), re.compile(r"[ ._-]*"), re.compile(r"[ ()./+-]*"))  # what may stand between digits


def widened(text: str, span: Span) -> Span:
    """The span without marks at its edges, out to the ends of its words, over the next numbers that a mark ties to it, and to a bracket or plus sign before it."""
    a, kind, b = span
    while a < b and not (text[a].isalnum() or text[a] in "(+"):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    tied = lambda mark, digit: kind > 0 and text[mark] in "._-/" and text[digit].isdigit()
    while 0 < a < b <= a + LONGEST and (text[a - 1].isalnum() or (a > 1 and tied(a - 1, a - 2))):
        a -= 1
    while a < b < min(len(text), a + LONGEST + 1) and (text[b].isalnum() or (b + 1 < len(text) and tied(b, b + 1))):
        b += 1
    if kind == 3 and a < b and a and ((text[a - 1] == "(" and ")" in text[a:b]) or text[a - 1] == "+"):
        a -= 1
    return a, kind, b


def accepted(text: str, span: Span) -> bool:
    """Whether the characters of a span can be of its kind, however they are set apart."""
    a, kind, b = span
    if b - a > LONGEST:
        return False
    s = text[a:b]
    if kind == 0:
        parts = AT.split(s)
        if len(parts) != 2:
            return False
        names = DOT.sub(".", parts[1]).split(".")
        return bool(parts[0]) and set(parts[0]) <= LOCAL and len(names) > 1 and all(n and set(n) <= LOCAL - set("._%+") for n in names) and names[-1].isalpha()
    digits = re.split("[^0-9]+", s.strip("()+ "))
    if not all(digits) or not all(BETWEEN[kind].fullmatch(x) for x in re.findall("[^0-9]+", s.strip("()+ "))):
        return False
    if kind == 1:
        return len(digits) == 4 and _small_parts(".".join(digits))
    if kind == 2:
        return _card(s)
    return len(digits) > 1 and _phone(s)


def added(text: str, tagged: list[Span], base: list[Span]) -> list[Span]:
    """The spans of the model that count, the earlier one of two that overlap."""
    out: list[Span] = []
    for span in sorted(widened(text, x) for x in tagged):
        if accepted(text, span) and not any(x < span[2] and span[0] < y for x, _, y in (*base, *out[-1:])):
            out.append(span)
    return out


def find(model: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    out = []
    for text, tagged in zip(texts, tag_texts(model, texts)):
        base = base_spans(text)
        out.append((base, sorted(base + added(text, tagged, base))))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row of ``docs``."""
    model = model or tagger()
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 4 << 20):
                raw, at = utf8(b.column(1))
                hits = np.concatenate(([0], np.cumsum(_signs(raw))))
                some = np.flatnonzero(hits[at[1:]] > hits[at[:-1]])
                found = dict(zip(some.tolist(), find(model, [b.column(1)[int(i)].as_py() for i in some])))
                rows = [found.get(i, ([], [])) for i in range(b.num_rows)]
                counts = [pa.array([sum(s[1] == k for s in x[0]) for x in rows], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *counts, pa.array([hashlib.sha256(_joined(x[0]).encode()).hexdigest() for x in rows], pa.string()), pa.array([_joined(x[1]) for x in rows], pa.string())],
                    names=names,
                )

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return shipped(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
