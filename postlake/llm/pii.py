"""Personal data: known patterns, and a semi-Markov conditional random field.

Patterns for e-mail addresses, IP addresses, card and phone numbers give the
base spans.  The field adds spans the patterns miss, such as phone numbers
without a plus sign or card numbers with other separators.  It scores whole
candidate segments of up to ``MAX_TOKENS`` tokens (digits in all, group
lengths, separators, check digit, what stands before and after) and a dynamic
programme over a region chooses boundaries and types together.

It is trained here, by maximum likelihood (forward-backward over segments,
AdaGrad), on a bounded sample of regions whose labels are the base spans, and on
altered copies of them: other separators and cut prefixes stay entities,
broken check digits, parts above 255 and shortened numbers do not.  A span is
added where its posterior probability is ``min_posterior`` or more.

The texts are read once: base spans and regions (the words around digits and
@) are written under the checkpoint folder, and both training and decoding
read those.  No shuffle; the sample is chosen by the smallest hashes.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from postlake.llm.common import materialised, with_python_columns

KINDS = ("email", "ip", "card", "phone")
# e-mail: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, found from its @ so that long runs stay linear
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behind changes no match (a run of digits is entered at its start); it keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile("[0-9@]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, sorted."""
    if not _ANCHOR.search(text):
        return []
    out, done, at = [], 0, text.find("@")
    low = 0  # the local part reaches back to here at most: past the last match and the last @
    while at >= 0:
        local = text[max(done, low):at]
        start = max(done, low) + len(local.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        low = at + 1
        at = text.find("@", max(at + 1, done))
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _small_parts(m[0])]
    for m in _CARD.finditer(text):
        d = _NOT_DIGIT.sub("", m[0]) if len(m[0]) < 60 else ""
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---------------------------------------------------------------- regions, tokens, segments

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TOKEN = re.compile("([A-Za-z\x80-\U0010ffff]+)|([0-9]+)|([^\x20\x09-\x0DA-Za-z0-9])")
AROUND = 2  # words of context on both sides of one with a digit or @
MAX_TOKENS = 16
CUES = frozenset(("tel", "phone", "call", "fax", "mobile", "card", "visa", "ip", "host", "server", "email", "mail"))


def regions(text: str) -> list[tuple[int, str]]:
    """(offset, text) of the words around digits and @, merged where they touch."""
    if not _ANCHOR.search(text):
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    out: list[list[int]] = []
    for i, (a, b) in enumerate(words):
        if _ANCHOR.search(text, a, b):
            lo, hi = max(0, i - AROUND), min(len(words) - 1, i + AROUND)
            if out and lo <= out[-1][1] + 1:
                out[-1][1] = hi
            else:
                out.append([lo, hi])
    return [(words[lo][0], text[words[lo][0]:words[hi][1]]) for lo, hi in out]


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, class): a letters, d digits, or the sign itself."""
    return [(m.start(), m.end(), "a" if m[1] else "d" if m[2] else m[3]) for m in _TOKEN.finditer(text)]


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & (FEATURES - 1)


FEATURES = 1 << 12
MOST_DIGITS = 19  # no kind has more
_KNOWN: dict[tuple, tuple[int, ...]] = {}


def _char(c: str) -> str:
    return "d" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def _shape(text: str, tok: list, i: int, j: int, digits: str, groups: list[int], signs: str) -> tuple:
    """All that a segment's features depend on."""
    a, b = tok[i][0], tok[j - 1][1]
    s, n = text[a:b], len(digits)
    if "@" in s:
        local, _, domain = s.partition("@")
        form = ("@", min(domain.count("."), 3), s.count("@"), "." in domain and domain.rpartition(".")[2].isalpha(), bool(local))
    else:
        form = ("#", 13 <= n <= MOST_DIGITS and luhn(digits), len(groups) == 4 and signs == "..." and (1 + _small_parts(s)),
                s[0] == "+", s.count("(") == s.count(")"), 10 <= n <= 15, "\x20" in s)
    k = i - 1
    while k >= 0 and tok[k][2] not in ("a", "d") and i - k < 4:
        k -= 1
    cue = text[tok[k][0]:tok[k][1]].lower() if k >= 0 and tok[k][2] == "a" and tok[k][1] - tok[k][0] <= 8 else ""
    return (min(n, 20), tuple(min(g, 7) for g in groups[:7]), min(len(groups), 7), "".join(sorted(set(signs))), form,
            _char(text[a - 1]) if a else "_", _char(text[b]) if b < len(text) else "_", cue if cue in CUES else "")


def _features(shape: tuple) -> tuple[int, ...]:
    """Feature numbers of a shape; shapes recur, so they are kept."""
    out = _KNOWN.get(shape)
    if out is None:
        n, groups, n_groups, signs, form, left, right, cue = shape
        f = ["bias", f"nd{n}", f"ng{n_groups}", "g" + "-".join(map(str, groups)), *("s" + c for c in signs)]
        if form[0] == "@":
            _, dots, ats, tld, local = form
            f += [f"dots{dots}", f"at{ats}", "tld" if tld else "notld", "local" if local else "nolocal"]
        else:
            _, passes, ip, plus, paired, phone, space = form
            f += [name for name, holds in (("luhn", passes), ("ipok", ip == 2), ("ipbad", ip == 1), ("plus", plus), ("paired", paired),
                                           ("unpaired", not paired), ("phonelength", phone), ("space", space)) if holds]
        f += ["l:" + left, "r:" + right] + (["cue:" + cue] if cue else [])
        out = tuple(_feature(x) for x in f)
        if len(_KNOWN) < 100_000:
            _KNOWN[shape] = out
    return out


def segments(text: str, tok: list) -> Iterator[tuple[int, int, tuple[int, ...]]]:
    """Candidate entities by first token: up to ``MAX_TOKENS`` tokens, at most one
    blank and no line end between two; either without letters and with 4 to
    ``MOST_DIGITS`` digits, or with one @ and no blank."""
    n = len(tok)
    for i in range(n):
        if tok[i][2] not in ("a", "d", "+", "("):
            continue
        letters, at, blank, digits, groups, signs = False, 0, False, "", [], ""
        for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
            a, b, c = tok[j - 1]
            if j > i + 1 and a > tok[j - 2][1]:
                if a - tok[j - 2][1] > 1 or text[a - 1] != "\x20":
                    break
                blank = True
            if c == "a":
                letters = True
            elif c == "d":
                digits += text[a:b][:40]
                groups.append(b - a)
            else:
                at += c == "@"
                signs += c
            if blank and (letters or at) or at > 1 or blank and len(digits) > MOST_DIGITS:
                break
            if c in ("a", "d") and (at == 1 if letters or at else 4 <= len(digits) <= MOST_DIGITS):
                yield i, j, _features(_shape(text, tok, i, j, digits, groups, signs))


# ---------------------------------------------------------------- the field

LABELS = 1 + len(KINDS)  # 0: outside, one token each


_NONE = -math.inf


def _logsum(xs: list[float]) -> float:
    m = max(xs)
    return m if m == _NONE else m + math.log(sum([math.exp(x - m) for x in xs]))


class Lattice:
    """The segments of one text, by first token, and their scores by kind: flat
    arrays, some 50 bytes a segment.  ``first[i]`` to ``first[i + 1]`` are the
    segments that begin at token i."""

    def __init__(self, n: int, segs: Iterable[tuple[int, int, tuple[int, ...]]], w: np.ndarray, keep: bool = False):
        self.n, self.first, self.begin, self.end, self.score = n, array("q", [0]), array("q"), array("q"), array("d")
        self.features: list[tuple[int, ...]] = []
        known: dict[tuple[int, ...], list[float]] = {}
        for i, j, f in segs:
            while len(self.first) <= i:
                self.first.append(len(self.end))
            s = known.get(f)
            if s is None:
                s = w[list(f)].sum(axis=0).tolist()
                if len(known) < 100_000:
                    known[f] = s
            self.begin.append(i)
            self.end.append(j)
            self.score.extend(s)
            if keep:
                self.features.append(f)
        while len(self.first) <= n:
            self.first.append(len(self.end))

    def __len__(self) -> int:
        return len(self.end)


class Field:
    """Weights of segment features by kind, and of label transitions (from the
    row's label to the column's)."""

    def __init__(self, w: np.ndarray | None = None, trans: np.ndarray | None = None):
        self.w = np.zeros((FEATURES, len(KINDS))) if w is None else w
        self.trans = np.zeros((LABELS, LABELS)) if trans is None else trans

    def forward(self, lat: Lattice) -> array:
        """Log-sums of all labellings of each prefix, by last label: LABELS
        numbers a position, the next positions' sums added to from each one."""
        L, into_of = LABELS, self.trans.T.tolist()
        alpha = array("d", [_NONE]) * ((lat.n + 1) * L)
        alpha[0] = 0.0
        first, end, score = lat.first, lat.end, lat.score
        for i in range(lat.n):
            here = alpha[i * L:i * L + L].tolist()
            to = (i + 1) * L
            alpha[to] = _logadd(alpha[to], _logsum([x + t for x, t in zip(here, into_of[0])]))
            if first[i] < first[i + 1]:
                into = [_logsum([x + t for x, t in zip(here, row)]) for row in into_of[1:]]
                for k in range(first[i], first[i + 1]):
                    to, at = end[k] * L + 1, k * (L - 1)
                    for y in range(L - 1):
                        alpha[to + y] = _logadd(alpha[to + y], into[y] + score[at + y])
        return alpha

    def backward(self, lat: Lattice) -> tuple[array, array]:
        """Per position the log-sums of all labellings of the rest, by the label
        before it, and by the label that follows."""
        L, trans = LABELS, self.trans.tolist()
        beta, follow = array("d", [0.0]) * ((lat.n + 1) * L), array("d", [_NONE]) * (lat.n * L)
        first, end, score = lat.first, lat.end, lat.score
        for i in range(lat.n - 1, -1, -1):
            nxt = [beta[(i + 1) * L]] + [_NONE] * (L - 1)
            for k in range(first[i], first[i + 1]):
                to, at = end[k] * L + 1, k * (L - 1)
                for y in range(L - 1):
                    nxt[y + 1] = _logadd(nxt[y + 1], score[at + y] + beta[to + y])
            for x in range(L):
                beta[i * L + x] = _logsum([t + v for t, v in zip(trans[x], nxt)])
                follow[i * L + x] = nxt[x]
        return beta, follow

    def posteriors(self, lat: Lattice, only: Iterable[int] | None = None) -> tuple[dict[int, list[float]], np.ndarray, float]:
        """Of the segments in ``only`` (default: all) the probability of each
        kind; the expected number of each transition; and the log of the sum of
        all labellings."""
        L = LABELS
        alpha, (beta, follow) = self.forward(lat), self.backward(lat)
        z = _logsum(alpha[lat.n * L:].tolist())
        out, into_of = {}, self.trans.T.tolist()
        for k in range(len(lat)) if only is None else only:
            i, to, at = lat.begin[k] * L, lat.end[k] * L + 1, k * (L - 1)
            out[k] = [math.exp(min(0.0, _logsum([x + t for x, t in zip(alpha[i:i + L], into_of[y + 1])]) + lat.score[at + y] + beta[to + y] - z))
                      for y in range(L - 1)]
        pair = np.zeros((L, L))
        if only is None:
            a, f = np.array(alpha[:lat.n * L]).reshape(-1, L), np.array(follow).reshape(-1, L)
            pair = np.exp(np.minimum(0.0, a[:, :, None] + self.trans[None] + f[:, None, :] - z)).sum(axis=0)
        return out, pair, z

    def best(self, lat: Lattice) -> list[tuple[int, int]]:
        """Viterbi: (segment, kind) of the entities of the best labelling."""
        L, into_of = LABELS, self.trans.T.tolist()
        v = array("d", [_NONE]) * ((lat.n + 1) * L)
        v[0] = 0.0
        came = array("q", [-1]) * ((lat.n + 1) * L)  # the segment, -1 outside
        prev = array("b", [0]) * ((lat.n + 1) * L)  # the label before
        for i in range(lat.n):
            here = v[i * L:i * L + L].tolist()
            into = []
            for y in range(L if lat.first[i] < lat.first[i + 1] else 1):
                xs = [x + t for x, t in zip(here, into_of[y])]
                top = max(xs)
                into.append((top, xs.index(top)))
            to = (i + 1) * L
            if into[0][0] > v[to]:
                v[to], came[to], prev[to] = into[0][0], -1, into[0][1]
            for k in range(lat.first[i], lat.first[i + 1]):
                to, at = lat.end[k] * L, k * (L - 1)
                for y in range(1, L):
                    s = into[y][0] + lat.score[at + y - 1]
                    if s > v[to + y]:
                        v[to + y], came[to + y], prev[to + y] = s, k, into[y][1]
        out, i = [], lat.n
        y = int(np.argmax(v[i * L:]))
        while i > 0:
            k, x = came[i * L + y], prev[i * L + y]
            if y:
                out.append((k, y - 1))
            i, y = lat.begin[k] if y else i - 1, x
        return out[::-1]

    def log_likelihood(self, lat: Lattice, gold: list[tuple[int, int]]) -> float:
        """Of the labelling with the entities ``gold`` (segment, kind)."""
        _, _, z = self.posteriors(lat, only=())
        return sum(lat.score[k * (LABELS - 1) + kind] for k, kind in gold) + float((self.trans * gold_pairs(lat, gold)).sum()) - z


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == _NONE else a + math.log1p(math.exp(b - a))


def gold_pairs(lat: Lattice, gold: list[tuple[int, int]]) -> np.ndarray:
    """How often each transition occurs in the labelling with those entities."""
    out, at, label = np.zeros((LABELS, LABELS)), 0, 0
    for k, kind in [*gold, (None, None)]:
        begin = lat.n if k is None else lat.begin[k]
        if begin > at:  # outside tokens, one transition each
            out[label, 0] += 1
            out[0, 0] += begin - at - 1
            label = 0
        if k is not None:
            out[label, kind + 1] += 1
            at, label = lat.end[k], kind + 1
    return out


def _gold(tok: list, lat: Lattice, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]] | None:
    """(segment, kind) of the spans, or None if one is no candidate."""
    place = {(tok[i][0], tok[j - 1][1]): k for k, (i, j) in enumerate(zip(lat.begin, lat.end))}
    out, done = [], 0
    for a, kind, b in sorted(spans, key=lambda s: (s[0], -s[2])):
        if a < done:
            continue
        if (a, b) not in place:
            return None
        out.append((place[a, b], kind))
        done = b
    return out


def _altered(text: str, spans: list[tuple[int, int, int]], rnd: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A copy of a region with its spans written otherwise, or broken so that
    they are none."""
    out, new, at = "", [], 0
    for a, kind, b in sorted(spans):
        if a < at:
            continue
        out += text[at:a]
        s, keep, d = text[a:b], rnd.random() < 0.6, _NOT_DIGIT.sub("", text[a:b])
        if kind == 2:
            if not keep:
                d = d[:-1] + str((int(d[-1]) + rnd.randint(1, 9)) % 10)
            sep = rnd.choice(("", " ", "-", "."))
            s = sep.join(d[i:i + 4] for i in range(0, len(d), 4))
        elif kind == 3:
            d = d[-10:]
            style = rnd.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"))
            s = style.format(d[:3], d[3:6], d[6:10] if keep else d[6:7])
        elif kind == 1 and not keep:
            s = re.sub("^[0-9]+", lambda m: str(256 + int(m[0][-3:])), s) if rnd.random() < 0.5 else s.rpartition(".")[0]
        elif kind == 0 and not keep:
            s = s.partition("@")[0] + rnd.choice(("@", "@" + s.partition("@")[2].split(".")[0]))
        if keep:
            new.append((len(out), kind, len(out) + len(s)))
        out, at = out + s, b
    return out + text[at:], new


def _plain_number(rnd: random.Random) -> str:
    """A date, a time, a version, a range or a number that names nobody."""
    day = f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}"
    hour = f"{rnd.randint(0, 23):02}:{rnd.randint(0, 59):02}"
    return rnd.choice((day, f"{day} {hour}", f"{day} {hour}:{rnd.randint(0, 59):02}", day.replace("-", "."),
                       f"{rnd.randint(0, 30)}.{rnd.randint(0, 30)}.{rnd.randint(0, 30)}",
                       f"{rnd.randint(1900, 1990)}-{rnd.randint(1991, 2030)}", str(rnd.randint(1000, 10**rnd.randint(5, 18))),
                       f"{rnd.randint(1, 999)},{rnd.randint(0, 999):03},{rnd.randint(0, 999):03}",
                       f"{rnd.randint(1, 999)} {rnd.randint(0, 999):03} {rnd.randint(0, 999):03}",
                       f"{rnd.random() * 1000:.5f}"))


#: Training reads this many tokens of a region; decoding reads all.
TRAIN_TOKENS = 200


def train(sample: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 4, rate: float = 0.3,
          l2: float = 1e-4, seed: int = 7) -> Field:
    """``sample``: region texts with their base spans.  Dates, times, versions
    and plain numbers join it as regions without any."""
    rnd, field, cases = random.Random(seed), Field(), []
    plain = [(f"on {_plain_number(rnd)} it", []) for _ in range(max(50, len(sample) // 4))]
    for text, spans in [*sample, *plain]:
        for t, s in ((text, spans), *((_altered(text, spans, rnd) for _ in range(2)) if spans else ())):
            tok = tokens(t)[:TRAIN_TOKENS]
            segs = list(segments(t, tok))
            gold = _gold(tok, Lattice(len(tok), segs, field.w), s)
            if segs and gold is not None:
                cases.append((len(tok), segs, gold))
    g_w, g_t = np.full_like(field.w, 1e-8), np.full_like(field.trans, 1e-8)
    for _ in range(epochs):
        rnd.shuffle(cases)
        for n, segs, gold in cases:
            lat = Lattice(n, segs, field.w, keep=True)
            rows, pairs = gradient(field, lat, gold)
            for f, g in rows:
                g = g[None, :] - l2 * field.w[f]
                g_w[f] += g * g
                field.w[f] += rate * g / np.sqrt(g_w[f])
            g = pairs - l2 * field.trans
            g_t += g * g
            field.trans += rate * g / np.sqrt(g_t)
    return field


def gradient(field: Field, lat: Lattice, gold: list[tuple[int, int]]) -> tuple[list[tuple[list[int], np.ndarray]], np.ndarray]:
    """Of the log-likelihood: per segment that matters its features and what is
    added to their weights by kind, and that of the transitions.  Observed less
    expected counts, the expected ones from the forward and backward sums."""
    post, expected, _ = field.posteriors(lat)
    want = dict(gold)
    rows = []
    for k, p in post.items():
        g = -np.array(p)
        if k in want:
            g[want[k]] += 1.0
        if np.abs(g).max() > 1e-4:
            rows.append((list(lat.features[k]), g))
    return rows, gold_pairs(lat, gold) - expected


def decode(field: Field, text: str, taken: list[tuple[int, int, int]], min_posterior: float) -> list[tuple[int, int, int, float]]:
    """Spans (start, kind, end, posterior) of a region that overlap no taken one
    (sorted by start).  Time and memory grow as the region's tokens."""
    tok = tokens(text)
    lat = Lattice(len(tok), segments(text, tok), field.w)
    if not len(lat):
        return []
    free, t, reach = [], 0, 0
    for k, kind in field.best(lat):
        a, b = tok[lat.begin[k]][0], tok[lat.end[k] - 1][1]
        while t < len(taken) and taken[t][0] < b:
            reach = max(reach, taken[t][2])
            t += 1
        if a >= reach:
            free.append((k, kind, a, b))
    if not free:
        return []
    post, _, _ = field.posteriors(lat, only=[k for k, *_ in free])
    return [(a, kind, b, post[k][kind]) for k, kind, a, b in free if post[k][kind] >= min_posterior]


_SPAN = ArrayType(StructType([StructField("start", IntegerType()), StructField("kind", IntegerType()),
                              StructField("end", IntegerType())]))
_REGION = ArrayType(StructType([StructField("start", IntegerType()), StructField("text", StringType()),
                                StructField("spans", _SPAN)]))


def _as_rows(spans) -> list[dict]:
    return [{"start": a, "kind": k, "end": b} for a, k, b in spans]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_regions: int = 2000,
                       min_posterior: float = 0.8) -> DataFrame:
    """Personal data in each text.

    Returns one row per input row: the id, ``base`` (pattern spans), ``added``
    (spans of the field; none overlaps a base span) as arrays of (start, kind
    number, end) by start, then kind, and ``posterior`` of the added ones.
    Positions in code points, ends exclusive; kinds as in ``KINDS``.

    ``sample_regions`` bounds the training sample: that many different regions
    with base spans, and as many without, with the smallest hashes.  Defined
    cases: a NULL or empty text has no spans; without any base span in the
    table there is nothing to learn from and nothing is added.
    """
    spark = docs.sparkSession
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def find():
        def run(texts):
            base, around = [], []
            for t in texts:
                spans = base_spans(t or "")
                base.append(_as_rows(spans))
                rows, k = [], 0
                for a, part in regions(t or ""):
                    b = a + len(part)
                    while k < len(spans) and spans[k][0] < a:
                        k += 1
                    own, k2 = [], k
                    while k2 < len(spans) and spans[k2][0] < b:
                        own.append((spans[k2][0] - a, spans[k2][1], spans[k2][2] - a))
                        k2 += 1
                    rows.append({"start": a, "text": part, "spans": _as_rows(own)})
                around.append(rows)
            return base, around
        return run
    found = materialised(with_python_columns(src, ["text"], StructType([
        StructField("base", _SPAN), StructField("regions", _REGION)]), find, keep=["id"]))

    # a region is a few words; those of more than 2,000 code points are left to decoding
    pool = found.select(F.explode("regions").alias("r")).where(F.length("r.text") <= 2000) \
        .select(F.xxhash64("r.text").alias("h"), F.col("r.text").alias("text"), F.col("r.spans").alias("spans")) \
        .dropDuplicates(["h"])
    sample = [(r["text"], [(s["start"], s["kind"], s["end"]) for s in r["spans"]])
              for some in ("size(spans) > 0", "size(spans) = 0")
              for r in pool.where(some).orderBy("h").limit(sample_regions).collect()]
    field = train(sample) if any(s for _, s in sample) else None
    sent = spark.sparkContext.broadcast(None if field is None else (field.w.astype(np.float32), field.trans))

    def label():
        model = None if sent.value is None else Field(sent.value[0].astype(np.float64), sent.value[1])

        def run(regions_of):
            added, posterior = [], []
            for rows in regions_of:
                new = []
                for r in rows if model else ():
                    taken = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
                    new += [(r["start"] + a, k, r["start"] + b, p) for a, k, b, p in decode(model, r["text"], taken, min_posterior)]
                added.append(_as_rows(x[:3] for x in new))
                posterior.append([x[3] for x in new])
            return added, posterior
        return run
    return with_python_columns(found.withColumnRenamed("id", id_col), ["regions"], StructType([
        StructField("added", _SPAN), StructField("posterior", ArrayType(DoubleType()))]), label, keep=[id_col, "base"])
