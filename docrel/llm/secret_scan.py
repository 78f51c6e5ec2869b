"""Secret scans: base patterns, and tokens that a Markov model of random strings explains better than one of identifiers.

Two character models of order one are trained from labelled samples. A token's score is the mean log-likelihood ratio of its
characters; tokens above the threshold of their length, set on the samples, are spans of kind random.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import with_columns

KINDS = ("assign", "access", "hex", "random")
# fixed values: the base patterns
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is just a match of [0-9a-f]+ that long
_STEMS = ("passw", "secret", "token", "api")

MIN_TOKEN = 8
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
#: Classes of length (from so many characters on); each has its own threshold, which one ordinary sample in PASSES passes.
LENGTHS, PASSES = (8, 10, 12, 14, 16, 20, 24, 32), 1000
#: Thresholds are this at least.
LEAST = 0.15

#: Parts of ordinary identifiers, paths and dates, for labelled samples.
PARTS = "get set is has to from new max min user name file path index count value data list map key item node tree page text word line code http url json xml html table row column date time zone year month day hour start end first last next prev open close read write load save parse format build make create delete update insert select where order group sum total average config option default server client request response error message event handler listener manager factory service model view controller test main util common base abstract interface impl string integer float double boolean array object class method function module package import export version release license copyright author email phone address city country language source target weight height width color style font size margin border header footer content title description summary report account customer supplier invoice payment price amount currency discount tax".split()


def _alphabet_class(c: str) -> int:
    i = ord(c)
    if 97 <= i <= 122:
        return i - 97
    if 65 <= i <= 90:
        return 26 + i - 65
    if 48 <= i <= 57:
        return 52 + i - 48
    return 62 + "+/_=-".find(c) if c in "+/_=-" else 67


_CODES = np.array([_alphabet_class(chr(i)) for i in range(128)], dtype=np.int64)
_N = 68


def labelled_samples(n: int = 16_000, seed: int = 5) -> list[tuple[str, int]]:
    """n random strings (1: hexadecimal, base 32, base 62 and base 64) and n ordinary identifiers (0), always the same."""
    out = []
    for i in range(n):
        h = hashlib.sha256(f"{seed}|{i}".encode()).digest()
        size = MIN_TOKEN + h[0] % 41
        long = hashlib.sha512(h).digest()
        kind = (long.hex(), base64.b32encode(long).decode(), base64.b64encode(long).decode().replace("+", "A").replace("/", "b"), base64.b64encode(long).decode())[i % 4]
        out.append((kind[:size], 1))
        w = [PARTS[x % len(PARTS)] for x in long[: 2 + h[1] % 4]]
        forms = (
            "_".join(w), "".join(x.title() for x in w), "-".join(w), "/".join(w), "".join(w), "_".join(w).upper(), "".join(w).upper(), f"{'-'.join(w)}-{2000 + h[2] % 30}-{1 + h[3] % 12:02}-{1 + h[4] % 28:02}",
            f"{w[0]}_{h[5]}_{w[1]}_{h[6]}{w[-1]}", f"{w[0]}{h[5]}{h[6]}", f"{w[0].title()}{w[1].title()}{h[5] % 10}", f"{2000 + h[2] % 30}-{1 + h[3] % 12:02}-{1 + h[4] % 28:02}", f"{w[0].upper()}-{h[5]}{h[6]:03}", f"{w[0]}{h[5] % 100}/{w[1]}", f"v{h[5] % 10}-{w[0]}-{h[6]}", w[0] + "".join(x.title() for x in w[1:]) + str(h[5] % 100),
        )
        out.append((forms[i % len(forms)], 0))
    return out


class Markov:
    """Two order-one character models. score(): mean log-likelihood ratio per character, random against ordinary."""

    def __init__(self, samples: list[tuple[str, int]], smooth: float = 0.5):
        counts = np.full((2, _N + 1, _N), smooth)  # row _N: the start
        for s, y in samples:
            c = self._codes(s)
            np.add.at(counts[y], (np.concatenate(([_N], c[:-1])), c), 1)
        logs = np.log(counts / counts.sum(axis=2, keepdims=True))
        self.ratio = logs[1] - logs[0]
        # by length, the least score at which one ordinary sample in PASSES passes; longer tokens need no higher a score than shorter ones
        ordinary: list[list[float]] = [[] for _ in LENGTHS]
        for text, y in samples:
            if not y and len(text) >= MIN_TOKEN and wanted(text):
                ordinary[bisect.bisect(LENGTHS, len(text)) - 1].append(self.score(text))
        cuts = [sorted(x)[min(len(x) - 1, math.ceil((1 - 1 / PASSES) * len(x)))] if x else LEAST for x in ordinary]
        self.thresholds = [max(LEAST, *cuts[i:]) for i in range(len(cuts))]

    def random(self, s: str) -> bool:
        """Whether s, of at least MIN_TOKEN characters, is over the threshold of its length."""
        return self.score(s) > self.thresholds[bisect.bisect(LENGTHS, len(s)) - 1]

    @staticmethod
    def _codes(s: str) -> np.ndarray:
        return _CODES[np.frombuffer(s.encode("ascii", "replace"), dtype=np.uint8) & 127]

    def score(self, s: str) -> float:
        c = self._codes(s)
        return float(self.ratio[np.concatenate(([_N], c[:-1])), c].mean()) if len(c) else 0.0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(s in low for s in _STEMS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def wanted(s: str) -> bool:
    """Whether the models judge a token: not if it is a word by its letters (capitals, if any, before all others, and not 16 or more
    capitals alone) or a number. Of random strings in base 62 fewer than one in 10,000 has that form, in base 32 (capitals) 26% at 8 characters
    and 3.6% at 16, where capitals are judged."""
    if s.isalpha():
        small = s.lstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        return not small.islower() if small else len(s) >= 16
    return not s.isdigit()


def random_spans(text: str, model: Markov, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Tokens that overlap no base span and that the model takes to be random. Longer ones are scored in whole."""
    out = []
    for m in _TOKEN.finditer(text):
        s = m.group()
        if wanted(s) and model.random(s) and not any(a < m.end() and m.start() < b for _, a, b in base):
            out.append(("random", *m.span()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def scan(docs: DataFrame, model: Markov | None = None) -> DataFrame:
    """docs with spans (array of kind, start, end in code points, by start), n_assign, n_access, n_hex, n_random.

    Whole texts; null is the empty text, with no spans. Columns with the new names are replaced, others pass untouched; equal texts have equal
    spans; repeated rows and null doc_ids stay as they are; an empty table gives an empty result.
    """
    model = model or Markov(labelled_samples())

    def run(texts: list[str | None]) -> dict[str, list]:
        every = []
        for t in texts:
            base = base_spans(t or "")
            every.append(sorted(base + random_spans(t or "", model, base), key=lambda s: (s[1], KINDS.index(s[0]), s[2])))
        return {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in every]} | {f"n_{k}": [sum(x[0] == k for x in s) for s in every] for k in KINDS}

    return with_columns(docs, {"spans": "array<struct<kind:string,start:int,end:int>>", **{f"n_{k}": "long" for k in KINDS}}, run)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "<secret>") -> str:
    """text with each run of covered characters replaced by mark."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])
