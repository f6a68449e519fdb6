"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

Texts are cut into tokens (runs of letters, digits and ``+/_.-``; runs of other visible characters). A
token has a few discrete features: shape (length, digits, case, hex, changes between letters and
digits), identity (key words, separators), its neighbours' identities, and features of its text. The
field scores the tags secret begin, inside and outside and is decoded by Viterbi.

It learns from two bounded samples over all documents: of those that hold a fixed pattern and of the
others (``SAMPLE`` expected in each, drawn by a hash). The spans of the fixed patterns are its first
labels. They all have a few shapes, so each place is also rewritten: other key words and signs, values
drawn from other alphabets and lengths (secret), and the same key words before plain words or none (no
secret). Thus key word and shape weigh together, and neither alone. All key words are one value of a
feature; plain words that a pattern takes for a value teach nothing, and training windows stop short of
values that follow a key word but fit no pattern. Decoding is exact: a token whose margin for
"outside" exceeds anything that transitions could win is outside in the best path, so only the runs
between such tokens need the recursion, and all runs of a batch step together.
"""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import flat, steps, word_hashes
from gustgrid.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ["assign", "access", "hex", "crf"]
# Fixed patterns: group 2 of 6 characters or more; whole matches of 20 and 24 characters or more.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# Documents with one of them, in Java's syntax; a few more may fit.
HOLDS = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"

# Bounds of the training set: expected documents in each sample, places used in a document (the first by a hash),
# rewritten copies of a place with and without a secret. Tokens of a training window.
SAMPLE, PLACES, SECRETS, PLAIN, WINDOW = 1_000, 4, 2, 2, 40
ROUNDS, RATE, DECAY = 80, 0.3, 1e-4
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

KEY_WORDS = ["password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "key", "pwd", "pass", "auth", "authorization", "bearer", "passphrase",
             "credential", "credentials", "private", "private_key", "access", "access_key", "access_token", "secret_key", "client_secret", "auth_token", "api_token",
             "db_password", "refresh_token", "signing_key", "login"]
# What stands between a rewritten key word and its value.
BETWEEN = ["=", " = ", ": ", ":", "=\"", ": '", "\": \"", " is ", " "]
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Alphabets of rewritten values with their least and greatest length.
ALPHABETS = [("abcdef" + _DIGITS, 12, 64), (_LOWER + _UPPER + _DIGITS, 10, 48), (_LOWER + _UPPER + _DIGITS + "+/", 16, 64), (_LOWER + _DIGITS, 8, 32),
             (_UPPER + _DIGITS, 10, 32), (_LOWER + _UPPER + _DIGITS + "_-", 12, 48), (_LOWER + _UPPER + _DIGITS + "_.", 24, 120)]
LONGEST_KEY = max(map(len, KEY_WORDS))
# The value of any key word, and those of assignment signs.
KEY, SIGNS = 1, (25, 26)
# Number of values of each feature.
SIZES = [8, 4, 5, 2, 5, 30, 30, 30, 30, 3, 3, 3]
_TOGETHER = [(0, 1, 2, 3, 4), (5, 6), (7, 8), (9, 10, 11)]

# Byte classes: white space and control characters, token characters (also all of non-ASCII), other visible ones.
_CLASS = np.full(256, 2, np.int8)
_CLASS[:0x21] = 0
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")] = 1
_CLASS[128:] = 1
_LETTER = np.zeros(256, np.int8)
_LETTER[48:58], _LETTER[65:91], _LETTER[97:123] = 1, 2, 2
# Two counters in one number: digits and hex digits, upper-case and lower-case letters.
_HALF = 1 << 32
_DIGIT_HEX, _UP_LOW = np.zeros(256, np.int64), np.zeros(256, np.int64)
_DIGIT_HEX[list(b"abcdefABCDEF")] = _HALF
_DIGIT_HEX[48:58] = 1 + _HALF
_UP_LOW[65:91] = 1
_UP_LOW[97:123] = _HALF
_HEADS = np.ones(256, np.int32)
_HEADS[0x80:0xC0] = 0
_INITIALS = np.zeros(256, bool)
_INITIALS[[ord(c) for w in KEY_WORDS for c in (w[0], w[0].upper())]] = True


def _sum(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _word_codes() -> np.ndarray:
    data = np.frombuffer("".join(KEY_WORDS).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in KEY_WORDS])
    return np.sort(word_hashes(data, ends - [len(w) for w in KEY_WORDS], ends, lower=True))


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    features: np.ndarray


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Bounds (bytes), row and features of every token of a batch."""
    kinds = _CLASS[data]
    if not len(data):
        none = np.empty(0, np.int64)
        return Tokens(none, none, none, np.zeros((0, len(SIZES)), np.int16))
    edge = np.append(True, kinds[1:] != kinds[:-1])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(edge)
    seen = kinds[at] > 0
    starts, ends = at[seen], np.append(at[1:], len(data))[seen]
    n = len(starts)
    if not n:
        return Tokens(starts, ends, starts, np.zeros((0, len(SIZES)), np.int16))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    body = kinds[starts] == 1
    length = ends - starts
    # White space between tokens counts for nothing, so sums may run on to the next token.
    both = np.add.reduceat(_DIGIT_HEX[data], starts)
    digits, hexed = both % _HALF, both // _HALF
    both = np.add.reduceat(_UP_LOW[data], starts)
    upper, lower = both % _HALF, both // _HALF
    letter = _LETTER[data]
    turns = np.append(False, (letter[1:] != letter[:-1]) & (kinds[1:] > 0))
    turns[starts] = False
    turns = np.add.reduceat(turns, starts, dtype=np.int64)

    codes = _word_codes()
    name = np.zeros(n, np.int64)
    maybe = np.flatnonzero(body & (length <= LONGEST_KEY) & (length >= 3) & _INITIALS[data[starts]])
    h = word_hashes(data, starts[maybe], ends[maybe], lower=True)
    at = np.minimum(np.searchsorted(codes, h), len(codes) - 1)
    name[maybe] = np.where(codes[at] == h, KEY, 0)
    first = data[starts]
    mark = np.select([first == ord("="), first == ord(":"), (first == 34) | (first == 39)], [25, 26, 27], 28)
    # An assignment sign behind a quote is still an assignment.
    mark = np.where((length > 1) & ((data[np.maximum(ends - 1, 0)] == ord("=")) | (data[np.maximum(ends - 1, 0)] == ord(":"))), 25, mark)
    name = np.where(body, name, mark)

    new = np.append(True, rows[1:] != rows[:-1])
    last = np.append(rows[1:] != rows[:-1], True)
    before = np.where(new, 29, np.append(29, name[:-1]))
    after = np.where(last, 29, np.append(name[1:], 29))
    before2 = np.where(new | np.append(True, new[:-1]), 29, np.concatenate([[29, 29], name[:-2]])[:n])
    texts = len(offsets) - 1
    size = np.maximum(offsets[1:] - offsets[:-1], 1)
    digit_share = np.bincount(rows, weights=digits, minlength=texts) / size
    mark_share = np.bincount(rows, weights=~body, minlength=texts) / np.maximum(np.bincount(rows, minlength=texts), 1)
    lines = _sum(data == 10, offsets[:-1], offsets[1:]) + 1
    features = np.stack([
        np.searchsorted([4, 8, 12, 16, 20, 32, 40], length, side="right"),
        np.where(digits == 0, 0, 1 + (digits * 5 > length) + (digits == length)),
        np.select([(upper == 0) & (lower == 0), (upper > 0) & (lower == 0), (upper == 0), upper == 1], [0, 1, 2, 3], 4),
        (hexed == length) & body, np.minimum(np.searchsorted([1, 3, 6, 10], turns, side="right"), 4),
        name, before, before2, after,
        np.searchsorted([0.01, 0.1], digit_share)[rows], np.searchsorted([0.02, 0.3], mark_share)[rows], np.searchsorted([60, 600], size / lines)[rows],
    ], axis=1)
    return Tokens(starts, ends, rows, features.astype(np.int16))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping for each kind; code points."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


@dataclass
class Field:
    """Weights of every feature value and tag, of tag pairs, and of the first tag."""

    emit: list[np.ndarray]
    step: np.ndarray
    start: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3), np.float32)
        for group in _TOGETHER:
            # The weights of a few features, summed once for every combination of their values.
            table, code = np.zeros((1, 3)), np.zeros(len(features), np.int32)
            for k in group:
                table = (table[:, None, :] + self.emit[k][None, :, :]).reshape(-1, 3)
                code = code * SIZES[k] + features[:, k]
            out += table.astype(np.float32)[code]
        return out

    def tags(self, tokens: Tokens) -> np.ndarray:
        """Best tags of all tokens, each row of the batch on its own."""
        score = self.emissions(tokens.features)
        n = len(score)
        tags = np.full(n, OUTSIDE, np.int8)
        if not n:
            return tags
        first = np.append(True, tokens.rows[1:] != tokens.rows[:-1])
        # The most that another tag can win by its transitions on both sides.
        into = np.concatenate([self.step, self.start[None, :]])
        gain = [max((into[:, y] - into[:, OUTSIDE]).max(), 0.0) + max((self.step[y] - self.step[OUTSIDE]).max(), 0.0) for y in (BEGIN, INSIDE)]
        open_ = (score[:, OUTSIDE] - score[:, BEGIN] <= gain[0] + 1e-3) | (score[:, OUTSIDE] - score[:, INSIDE] <= gain[1] + 1e-3)
        begin = open_ & (first | ~np.append(False, open_[:-1]))
        runs = np.flatnonzero(begin)
        if not len(runs):
            return tags
        stop = np.flatnonzero(open_ & np.append(begin[1:] | ~open_[1:], True)) + 1
        size = stop - runs
        order = np.argsort(-size, kind="stable")
        runs, stop, size = runs[order], stop[order], size[order]
        # A run follows a sure "outside" or begins its row; it ends before one or ends its row.
        value = np.where(first[runs][:, None], self.start, self.step[OUTSIDE]) + score[runs]
        back = []
        for t in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -t, side="left"))
            through = value[:live, :, None] + self.step[None]
            back.append(through.argmax(axis=1).astype(np.int8))
            value[:live] = through.max(axis=1) + score[runs[:live] + t]
        tail = (stop < n) & ~np.append(first, True)[stop]
        value = value + np.where(tail[:, None], self.step[:, OUTSIDE], 0.0)
        now = value.argmax(axis=1).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, side="left")) if t else len(size)
            tags[runs[:live] + t] = now[:live]
            if t:
                now[:live] = back[t - 1][np.arange(live), now[:live]]
        return tags


def _spans_of(tags: np.ndarray, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last token and row of each tagged span; "inside" without a begin begins one."""
    first = np.append(True, tokens.rows[1:] != tokens.rows[:-1]) if len(tags) else np.empty(0, bool)
    secret = tags != OUTSIDE
    begin = secret & ((tags == BEGIN) | first | ~np.append(False, secret[:-1])[: len(tags)])
    after = np.append(begin[1:] | ~secret[1:] | first[1:], True)[: len(tags)] if len(tags) else begin
    a, b = np.flatnonzero(begin), np.flatnonzero(secret & after)
    return a, b, tokens.rows[a]


def _gold(tokens: Tokens, spans: list[list[tuple[int, int]]]) -> np.ndarray:
    """Tags of byte spans: tokens that overlap one; its first begins."""
    tags = np.full(len(tokens.starts), OUTSIDE, np.int8)
    for row_spans in spans:
        for a, b in row_spans:
            i, j = np.searchsorted(tokens.ends, a, side="right"), np.searchsorted(tokens.starts, b, side="left")
            tags[i:j] = INSIDE
            if j > i:
                tags[i] = BEGIN
    return tags


def _value(rng: random.Random) -> str:
    """A made-up secret: letters and digits of one alphabet, at least one of each."""
    alphabet, least, most = rng.choice(ALPHABETS)
    body = [rng.choice(alphabet) for _ in range(rng.randint(least, most) - 2)]
    for part in (rng.choice(_DIGITS), rng.choice([c for c in alphabet if c.isalpha()])):
        body.insert(rng.randint(0, len(body)), part)
    return "".join(body)


def _rewritten(text: str, a: int, b: int, seed: int) -> list[tuple[str, int, int]]:
    """Copies of the place around ``text[a:b]`` with other key words: (snippet, start and end of the secret; equal without one)."""
    rng = random.Random(seed)
    left, right = text[max(0, a - 160) : a], text[b : b + 160]
    if left and not left[-1].isspace():
        left += " "
    words = [w for w in re.findall(r"[A-Za-z\u00C0-\u024F]{2,14}", left + right) if w.lower() not in KEY_WORDS] or ["value"]
    out = []
    for k in range(SECRETS + PLAIN):
        key, sign = rng.choice(KEY_WORDS), rng.choice(BETWEEN)
        key = rng.choice([key, key.upper(), key.capitalize()])
        head = f"{left}{key}{sign}"
        if k < SECRETS:
            value = _value(rng)
            close = sign[-1] if sign[-1] in "\"'" else ""
            out.append((f"{head}{value}{close} {right.lstrip()}", len(head), len(head) + len(value)))
        else:
            out.append((f"{head}{' '.join(rng.choice(words) for _ in range(rng.randint(1, 4)))}{right}", 0, 0))
    return out


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows: around secret values, in rewritten places, and one elsewhere in every document."""
    for batch in batches:
        for part in steps(batch, "text"):
            data, offsets = flat(part.column(0))
            tokens = tokens_of(data, offsets)
            texts = [t or "" for t in part.column(0).to_pylist()]
            spans, snippets, origin = [], [], []
            bounds = np.searchsorted(tokens.rows, np.arange(len(texts) + 1))
            seeds = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts]
            skip: set[tuple[int, int]] = set()
            for r, text in enumerate(texts):
                own, places = [], []
                for a, k, b in base_spans(text):
                    places.append((a, b))
                    if k == 0:
                        a = b - len(ASSIGN.match(text, a)[2])
                    head = int(offsets[r]) + len(text[:a].encode())
                    own.append((head, head + len(text[a:b].encode())))
                    if text[a:b].isalpha():
                        # Perhaps a plain word behind a key word.
                        skip.add((r, head))
                spans.append(own)
                places = sorted(places, key=lambda p: zlib.crc32(f"{seeds[r]}:{p[0]}".encode()))[:PLACES]
                for n, (a, b) in enumerate(places):
                    made = _rewritten(text, a, b, seeds[r] + n)
                    snippets += made
                    origin += [r] * len(made)
            tags = _gold(tokens, spans)
            # Perhaps secrets that no pattern finds: values with digits, of 8 characters or more, behind a key word and a sign.
            x = tokens.features
            doubt = (tags == OUTSIDE) & (x[:, 0] >= 2) & (x[:, 1] > 0) & ((x[:, 6] == KEY) | (x[:, 7] == KEY) & np.isin(x[:, 6], SIGNS))
            unsure = np.array([(int(r), int(a)) in skip for r, a in zip(tokens.rows, tokens.starts)], bool) if skip else np.zeros(len(tags), bool)
            doubt = np.flatnonzero(doubt | unsure)
            out_x, out_y = [], []

            def add(features: np.ndarray, own: np.ndarray, p: int, lo: int, hi: int, stops: np.ndarray) -> None:
                a, b = max(lo, p - WINDOW // 2), min(hi, p + WINDOW // 2)
                k = int(np.searchsorted(stops, p))
                a, b = max(a, int(stops[k - 1]) + 1) if k else a, min(b, int(stops[k])) if k < len(stops) else b
                if a < b:
                    out_x.append(features[a:b].tobytes())
                    out_y.append(own[a:b].tobytes())

            for r in range(len(texts)):
                lo, hi = int(bounds[r]), int(bounds[r + 1])
                picks = (lo + np.flatnonzero(tags[lo:hi] == BEGIN)).tolist()
                picks = sorted(picks, key=lambda p: zlib.crc32(f"{seeds[r]}:{p - lo}".encode()))[:PLACES]
                if hi > lo:
                    picks.append(lo + seeds[r] % (hi - lo))
                for p in picks:
                    add(x, tags, p, lo, hi, doubt)
            if snippets:
                data, offsets = flat(pa.array([s for s, _, _ in snippets]))
                made = tokens_of(data, offsets)
                found = []
                for k, (s, a, b) in enumerate(snippets):
                    head = int(offsets[k])
                    found.append([(head + len(s[:a].encode()), head + len(s[:b].encode()))] if b > a else [])
                own = _gold(made, found)
                # Features of the text are those of the whole document.
                first = bounds[:-1][np.array(origin)]
                made.features[:, 9:] = x[first[made.rows], 9:]
                cuts, none = np.searchsorted(made.rows, np.arange(len(snippets) + 1)), np.empty(0, np.int64)
                for k, (s, a, b) in enumerate(snippets):
                    lo, hi = int(cuts[k]), int(cuts[k + 1])
                    at = np.flatnonzero(own[lo:hi] == BEGIN)
                    add(made.features, own, lo + int(at[0]) if len(at) else (lo + hi) // 2, lo, hi, none)
            yield pa.RecordBatch.from_arrays([pa.array(out_x, pa.binary()), pa.array(out_y, pa.binary())], ["x", "y"])


def train(windows: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """Penalised maximum likelihood by adaptive gradient steps over all windows at once."""
    field = Field([np.zeros((s, 3)) for s in SIZES], np.zeros((3, 3)), np.zeros(3))
    if not any((y != OUTSIDE).any() for _, y in windows):
        # Nothing to learn from: everything is outside.
        field.emit[0][:, OUTSIDE] = 10.0
        return field
    windows = sorted(windows, key=lambda w: (len(w[1]), w[0].tobytes()))
    n, t = len(windows), max(len(y) for _, y in windows)
    x, y, on = np.zeros((n, t, len(SIZES)), np.int16), np.full((n, t), OUTSIDE), np.zeros((n, t), bool)
    for i, (a, b) in enumerate(windows):
        x[i, : len(b)], y[i, : len(b)], on[i, : len(b)] = a, b, True
    flat_x, flat_on = x.reshape(-1, len(SIZES)), on.reshape(-1)
    hot = np.eye(3)[y] * on[:, :, None]
    pairs = np.zeros((3, 3))
    np.add.at(pairs, (y[:, :-1][on[:, 1:]], y[:, 1:][on[:, 1:]]), 1.0)
    state = [np.full_like(w, 1e-8) for w in (*field.emit, field.step, field.start)]
    for _ in range(ROUNDS):
        e = field.emissions(flat_x).reshape(n, t, 3).astype(float)
        fwd, bwd = np.zeros((n, t, 3)), np.zeros((n, t, 3))
        fwd[:, 0] = field.start + e[:, 0]
        for k in range(1, t):
            new = np.logaddexp.reduce(fwd[:, k - 1, :, None] + field.step[None], axis=1) + e[:, k]
            fwd[:, k] = np.where(on[:, k, None], new, fwd[:, k - 1])
        total = np.logaddexp.reduce(fwd[:, -1], axis=1)
        for k in range(t - 2, -1, -1):
            new = np.logaddexp.reduce(field.step[None] + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], axis=2)
            bwd[:, k] = np.where(on[:, k + 1, None], new, 0.0)
        node = np.exp(np.clip(fwd + bwd - total[:, None, None], -60, 0)) * on[:, :, None]
        edge = np.exp(np.clip(fwd[:, :-1, :, None] + field.step + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - total[:, None, None, None], -60, 0))
        miss = (hot - node).reshape(-1, 3)
        grads = [np.stack([np.bincount(flat_x[flat_on, k], weights=miss[flat_on, c], minlength=s) for c in range(3)], axis=1) for k, s in enumerate(SIZES)]
        grads += [pairs - (edge * on[:, 1:, None, None]).sum(axis=(0, 1)), (hot[:, 0] - node[:, 0]).sum(axis=0)]
        for w, g, s in zip((*field.emit, field.step, field.start), grads, state):
            g = g / n - DECAY * w
            s += g * g
            w += RATE * g / np.sqrt(s)
    return field


def _scan(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                data, offsets = flat(part.column(1))
                tokens = tokens_of(data, offsets)
                a, b, rows = _spans_of(field.tags(tokens), tokens)
                found: dict[int, list[tuple[int, int]]] = {}
                for i, j, r in zip(a, b, rows):
                    found.setdefault(int(r), []).append((int(tokens.starts[i]), int(tokens.ends[j])))
                out = []
                for r, text in enumerate(part.column(1).to_pylist()):
                    base = base_spans(text or "")
                    more = []
                    if r in found:
                        heads = np.concatenate([[0], np.cumsum(_HEADS[data[offsets[r] : offsets[r + 1]]])])
                        for x, y in found[r]:
                            x, y = int(heads[x - offsets[r]]), int(heads[y - offsets[r]])
                            if all(y <= p or x >= q for p, _, q in base):
                                more.append((x, 3, y))
                    out.append((*(sum(k == kind for _, k, _ in base) for kind in range(3)), joined(base), joined(base + more)))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                columns = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "n_assign", "n_access", "n_hex", "base", "spans"])

    return run


def fit_field(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field:
    """The field of ``sample`` expected documents with a fixed pattern and as many without (all, if there are fewer)."""
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Ids may be null or repeat, so texts count too.
    drawn = texts.withColumn("draw", F.expr("pmod(xxhash64(id, length(text), left(text, 200)), 1000000000000L)"))
    holding = stage(drawn.filter(F.col("text").rlike(HOLDS)), "secrets")
    sizes = [docs.count(), holding.count()]
    if not sizes[1]:
        return train([])
    limits = [int(min(1.0, sample / max(n, 1)) * 10**12) for n in (sizes[0] - sizes[1], sizes[1])]
    picked = drawn.filter(f"draw < {limits[0]}L").filter(~F.coalesce(F.col("text").rlike(HOLDS), F.lit(False))).unionByName(holding.filter(f"draw < {limits[1]}L"))
    got = picked.select("text").mapInArrow(_windows, "x binary, y binary").collect()
    return train([(np.frombuffer(r.x, np.int16).reshape(-1, len(SIZES)), np.frombuffer(r.y, np.int8)) for r in got])


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per document row: ``id_col, n_assign, n_access, n_hex, base, spans``.

    ``base`` and ``spans`` list kind:start:end by start and kind; spans of the field that overlap no
    fixed one are added as kind crf. Null and empty texts have none. Ids may be null or repeat.
    """
    field = field or fit_field(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scan(field), f"id {kind}, n_assign long, n_access long, n_hex long, base string, spans string").withColumnRenamed("id", id_col)

