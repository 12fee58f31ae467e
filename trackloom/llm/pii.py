"""Personal data: fixed patterns for mail addresses, IP addresses, cards and phones, and a linear-chain CRF for the rest.

The patterns are matched on every whole text, each kind by itself, leftmost and without overlap. The CRF labels tokens
(runs of letters and digits, single other characters) with B-kind, I-kind or O from word-shape features of the token and
its neighbours. It is trained on the labelled table in this module by gradient ascent on the conditional likelihood,
forward and backward sums over all sequences at once. What it adds are written-out addresses ("jo at site dot org"),
phones without a plus sign, cards and addresses with other separators, and numbers that a pattern has run past.

A token may only carry a label if a cue (a digit, @, or a word such as "at", "dot", "phone") is at most `NEAR` tokens
away; all others are O by the model's definition. So a text falls into runs of open tokens, the best labels of each run
do not depend on the others, and Viterbi decodes all runs of a slice in one numpy batch. Spans that overlap one of a
pattern are left out; those of the patterns always stay.

Defined cases: a null or empty text has no spans; repeated rows are scanned one by one; positions are code points, end
exclusive; spans that start together are ordered by kind; very long texts and words are scanned in linear time; bytes that
are no valid UTF-8 become U+FFFD; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trackloom.llm.common import ship, slices, strings

KINDS = ("email", "ip", "card", "phone")
NEAR = 6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, since it takes runs whole
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the mail pattern. No local part holds an @, so each match is found from its @ in linear time."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            end = m.end()
            out.append((a, end))
        at = text.find("@", max(at + 1, end))
        end = max(end, text.rfind("@", end, at) + 1) if at >= 0 else end
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find and their checks let stand."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# The labelled table: [kind text] marks a span. Lines without one are clean.
LABELLED = """
write to [email jane dot doe at example dot org] for details
mail me: [email peter at web dot de] thanks
contact [email info (at) firma (dot) com] or call
her address is [email m.lopez [at] correo.es] today
[email support [at] shop [dot] net]
reach [email anna_k AT mail DOT example DOT com], please
send it to [email max.muster (at) beispiel.de].
kontakt: [email verein at posteo punkt de]
ecrire a [email jean at orange point fr] avant lundi
or [email x12 at lists dot site dot org] instead
call [phone 555-123-4567] now
phone: [phone (555) 987-6543]
tel. [phone 030 1234567] oder
mobile [phone 0176 12345678] ok
fax [phone 020 7946 0958]
call [phone 1-800-555-0199] today
ring [phone (212) 555 0147], ask for Ann
Telefon: [phone 089/1234567]
tel [phone 01 42 68 53 00] merci
number [phone 555.867.5309] is mine
phone [phone +1 (826) 555-4081] [ip 190.137.223.204] seen
the [phone +1 (544) 555-8128] [ip 10.20.30.40]
[phone +1 (609) 555-7932] [phone +1 (058) 555-3468] here
call [phone +49 30 1234567] [ip 192.168.1.77] again
card [card 4111.1111.1111.1111] exp
visa [card 5500/0000/0000/0004] paid
card number [card 3400_0000_0000_009] is old
card: [card 4012 . 8888 . 8888 . 1881] ok
visa [card 6011.0009.9013.9424]
paid by [card 4222.2222.2222.2220] then
server [ip 10 dot 0 dot 0 dot 1] down
from [ip 192[.]168[.]0[.]15] port
host [ip 203(.)0(.)113(.)9] up
ping [ip 172 . 16 . 254 . 3] again
blocked [ip 198[.]51[.]100[.]23]
in 1998 the town had 12,345 people
version 3.14.2 and 2.0.1 of the tool
on 12-05-2021 at 14:30 we met
on 2024-01-31 the dot was at the top
the price is 19.99 or 1,250.00 at most
pages 10-20 and 33 to 47 of chapter 5
look at the red dot on page 12
he was at home at 7 and at work at 9
meet me at 10 Main Street at noon
token = b44e15e09fd311c3cf3163b66d5a9875b8
id 9a8b99b6f89edc9746a2ef7e89e21f68bcb454 at end
isbn 978-3-16-148410-0 is a book
the sum of 5295745161764471 and 17
order 20240131 of 2023/24 for 3 items
ratio 16:9 at 1080 x 1920 and 60
born 1970 , died 2020 ( aged 50 )
see section 4.2.1.3 at the end of it
a dot , a line and a point at once
he looked at dot com firms at large
3 4 5 6 7 8 9
100 200 300 400 500
call him at once at the phone
the phone number is at the top
my card is at home
0.5 0.25 0.125 0.0625
§ 12 abs. 3 satz 1
copyright 2001-2021 all rights reserved
12 34 56
10 000 000 of 25 000 000
build 1234.5678.90
room 12a at level 3b
2 + 2 = 4 and 10 - 3 = 7
tel aviv at night
win32 x86_64 utf8 mp3
99 % at 20 degrees
"""

# fixed words that tell tokens apart beyond their shape; all are cues
WORDS = frozenset("at dot punkt point arroba phone tel telefon fax mobile call card visa".split())
_TOKEN = re.compile(r"[^\W_]+|[^\s]")
_MARK = re.compile(r"\[(email|ip|card|phone) ((?:\[[^\]]*\]|[^\[\]])*)\]")


def shape(token: str) -> str:
    """Digits by their number, letters by case and rough length, other characters as they are."""
    low = token.lower()
    if low in WORDS:
        return low
    if token.isascii() and token.isdigit():
        return "9" * min(len(token), 9)
    if token.isalpha():
        case = "x" if token == low else "X" if token.isupper() else "Xx"
        return case if len(token) > 3 else f"{case}{len(token)}"
    if token.isalnum():
        return "x9" if len(token) <= 6 else "x9+"
    return token


def features(shapes: list[str], spaced: list[bool]) -> list[list[str]]:
    """The features of each token of a sequence: its own shape and those up to two places away, with the spaces between."""
    n = len(shapes)
    at = lambda i: shapes[i] if 0 <= i < n else "-"
    gap = lambda i: " " if i <= 0 or i >= n or spaced[i] else ""
    out = []
    for i, s in enumerate(shapes):
        left, right = f"{at(i - 1)}{gap(i)}", f"{gap(i + 1)}{at(i + 1)}"
        out.append([
            f"0{s}", f"1{left}_{s}", f"2{s}_{right}", f"3{left}_{right}", f"4{at(i - 2)}{gap(i - 1)}{left}_{s}", f"5{s}_{right}{gap(i + 2)}{at(i + 2)}",
            f"6{at(i - 2)}", f"7{at(i + 2)}",
        ])
    return out


STATES = 1 + 2 * len(KINDS)  # O, then B and I of each kind
#: which label may follow which, and which may open a run
_ALLOWED = np.ones((STATES, STATES), bool)
for _k in range(len(KINDS)):
    _ALLOWED[:, 2 + 2 * _k] = False
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
_OPENS = _ALLOWED[0]
_NEVER = -1e30


def _labelled() -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, spans) of the table's lines."""
    out = []
    for line in LABELLED.strip().splitlines():
        text, spans, end = "", [], 0
        for m in _MARK.finditer(line):
            text += line[end : m.start()]
            spans.append((len(text), KINDS.index(m.group(1)), len(text) + len(m.group(2))))
            text, end = text + m.group(2), m.end()
        out.append((text + line[end:], spans))
    return out


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def is_cue(token: str) -> bool:
    return token == "@" or token.lower() in WORDS or any("0" <= c <= "9" for c in token)


def open_runs(cue: np.ndarray) -> list[tuple[int, int]]:
    """Runs of places that are at most NEAR from a cue."""
    at = np.flatnonzero(cue)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 2 * NEAR + 1)
    first, last = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]
    return list(zip(np.maximum(first - NEAR, 0).tolist(), np.minimum(last + NEAR + 1, len(cue)).tolist()))


class Model:
    """Weights of features by label, of label pairs, and of the labels that open a run."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, step: np.ndarray):
        self.names, self.emit, self.step = names, emit, step
        self._rows: dict[tuple, np.ndarray] = {}

    def scores(self, shapes: list[str], spaced: list[bool]) -> np.ndarray:
        """(tokens, labels): the summed weights of each token's features."""
        known = [[self.names[f] for f in fs if f in self.names] for fs in features(shapes, spaced)]
        out = np.zeros((len(known), STATES), np.float32)
        for i, k in enumerate(known):
            if k:
                out[i] = self.emit[k].sum(axis=0)
        return out


def _batch(lengths: np.ndarray):
    """Sequences by falling length and, for each step, how many have it."""
    order = np.argsort(-lengths, kind="stable")
    alive = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")
    return order, alive


def viterbi(scores: list[np.ndarray], step: np.ndarray) -> list[np.ndarray]:
    """The best labels of each sequence; all sequences advance together, finished ones drop out."""
    lengths = np.array([len(s) for s in scores], np.int64)
    order, alive = _batch(lengths)
    starts = np.cumsum(lengths) - lengths
    flat = np.concatenate([*scores, np.zeros((0, STATES), np.float32)])
    back = np.zeros((len(flat), STATES), np.int8)
    first = starts[order]
    total = np.where(_OPENS, 0, _NEVER) + flat[first] if len(order) else np.zeros((0, STATES))
    for t in range(1, len(alive)):
        n = alive[t]
        via = total[:n, :, None] + step
        back[first[:n] + t] = via.argmax(axis=1)
        total[:n] = via.max(axis=1) + flat[first[:n] + t]
    labels = np.zeros(len(flat), np.int8)
    # `total` rows stay as they were when their sequence ended
    labels[first + lengths[order] - 1] = total.argmax(axis=1)
    for t in range(len(alive) - 1, 0, -1):
        at = first[: alive[t]] + t
        labels[at - 1] = back[at, labels[at]]
    return [labels[a : a + n] for a, n in zip(starts, lengths)]


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(rounds: int = 150, rate: float = 0.3, ridge: float = 0.01) -> Model:
    """Fit the labelled table: AdaGrad on the conditional log-likelihood with an L2 penalty. Size fixed by the table."""
    shapes, spaced, gold = [], [], []
    for text, spans in _labelled():
        spots = tokens_of(text)
        words = [text[a:b] for a, b in spots]
        label = np.zeros(len(spots), np.int64)
        for a, k, b in spans:
            inside = [i for i, (x, y) in enumerate(spots) if a <= x and y <= b]
            label[inside] = 2 + 2 * k
            label[inside[0]] = 1 + 2 * k
        for lo, hi in open_runs(np.array([is_cue(w) for w in words])):
            shapes.append([shape(w) for w in words[lo:hi]])
            spaced.append([i == 0 or spots[i - 1][1] < spots[i][0] for i in range(lo, hi)])
            gold.append(label[lo:hi])
    every = [features(s, g) for s, g in zip(shapes, spaced)]
    names: dict[str, int] = {}
    ids = [[[names.setdefault(f, len(names)) for f in fs] for fs in seq] for seq in every]
    lengths = np.array([len(s) for s in ids])
    n, longest, width = len(ids), int(lengths.max()), len(ids[0][0])
    grid = np.full((n, longest, width), len(names))  # the last feature is padding
    truth = np.zeros((n, longest), np.int64)
    for i, (seq, g) in enumerate(zip(ids, gold)):
        grid[i, : len(seq)] = seq
        truth[i, : len(g)] = g
    real = np.arange(longest) < lengths[:, None]
    emit, step = np.zeros((len(names) + 1, STATES)), np.zeros((STATES, STATES))
    pull_emit, pull_step = np.full_like(emit, 1e-8), np.full_like(step, 1e-8)
    barred = np.where(_ALLOWED, 0, _NEVER)
    for _ in range(rounds):
        scores = emit[grid].sum(axis=2)
        moves = step + barred
        ahead, behind = np.empty((2, n, longest, STATES))
        ahead[:, 0] = scores[:, 0] + np.where(_OPENS, 0, _NEVER)
        for t in range(1, longest):
            new = _sum_exp(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        behind[:, longest - 1] = 0
        for t in range(longest - 2, -1, -1):
            new = _sum_exp(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], new, 0)
        norm = _sum_exp(ahead[:, -1], 1)
        miss = np.eye(STATES)[truth] - np.exp(ahead + behind - norm[:, None, None])
        miss[~real] = 0
        up = np.zeros_like(emit)
        np.add.at(up, grid.reshape(-1), np.repeat(miss.reshape(-1, STATES), width, axis=0))
        both = ahead[:, :-1, :, None] + moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        seen = np.zeros_like(step)
        np.add.at(seen, (truth[:, :-1][real[:, 1:]], truth[:, 1:][real[:, 1:]]), 1)
        up_step = seen - np.exp(both[real[:, 1:]]).sum(axis=0)
        up[-1] = 0
        for w, g, pull in ((emit, up, pull_emit), (step, up_step, pull_step)):
            g -= ridge * w
            pull += g * g
            w += rate * g / np.sqrt(pull)
    return Model(names, emit[:-1].astype(np.float32), np.where(_ALLOWED, step, _NEVER))


@cache
def worker_model(packed: bytes) -> Model:
    """The model of a Python worker, from what `pack_model` has made."""
    import pickle

    return Model(*pickle.loads(packed))


def pack_model(model: Model) -> bytes:
    import pickle

    return pickle.dumps((model.names, model.emit, model.step))


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_CODES = np.array([int.from_bytes(w.encode(), "little") for w in sorted(WORDS)], np.uint64)


def cues(texts: list[str]) -> list[list[int]]:
    """The places of each text where a token that is a cue may begin or go on, in order."""
    flat = np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)
    inside = _ALNUM[flat]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    size = ends - starts
    code, short = np.zeros(len(starts), np.uint64), size <= 8
    for k in range(8):
        on = np.flatnonzero(short & (size > k))
        code[on] |= (flat[starts[on] + k].astype(np.uint64) | np.uint64(0x20)) << np.uint64(8 * k)
    upto = np.concatenate([[0], np.cumsum((flat >= 48) & (flat <= 57))])
    cue = (upto[ends] > upto[starts]) | (short & np.isin(code, _CODES))
    at = np.sort(np.concatenate([starts[cue], np.flatnonzero(flat == 64)]))
    chars = np.cumsum((flat & 0xC0) != 0x80) - 1
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    place = chars[at]
    cuts = np.searchsorted(place, edges)
    return [(place[x:y] - e).tolist() for x, y, e in zip(cuts, cuts[1:], edges)]


def _left(text: str, pos: int) -> int:
    """Where the token NEAR tokens before the one at `pos` begins, or the first one."""
    size = 64
    while True:
        lo = max(0, pos - size)
        starts = [m.start() for m in _TOKEN.finditer(text, lo, pos)]
        if lo and starts and starts[0] == lo:
            del starts[0]  # may be the rest of a longer one
        if len(starts) >= NEAR or not lo:
            return starts[-NEAR] if len(starts) >= NEAR else min([*starts[:1], pos])
        size *= 4


def regions(text: str, places: list[int]) -> list[tuple[int, int]]:
    """The stretches of a text that its runs of open tokens cover, from the places of possible cues."""
    out: list[tuple[int, int]] = []
    for pos in places:
        while pos and text[pos].isalnum() and text[pos - 1].isalnum():
            pos -= 1
        near = [m.span() for m in islice(_TOKEN.finditer(text, pos), NEAR + 1)]
        if not is_cue(text[pos : near[0][1]]):
            continue
        lo, hi = _left(text, pos), near[-1][1]
        if out and (lo <= out[-1][1] or text[out[-1][1] : lo].isspace()):
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def found_by_chain(texts: list[str], model: Model) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the spans that the model labels in each text."""
    where, spots, scores = [], [], []
    for d, (text, places) in enumerate(zip(texts, cues(texts))):
        for lo, hi in regions(text, places) if places else ():
            at = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
            gaps = [not lo or text[lo - 1].isspace(), *(x[1] < y[0] for x, y in zip(at, at[1:]))]
            where.append(d)
            spots.append(at)
            scores.append(model.scores([shape(text[a:b]) for a, b in at], gaps))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for d, at, labels in zip(where, spots, viterbi(scores, model.step)):
        i = 0
        while i < len(labels):
            if labels[i]:
                j = i + 1
                while j < len(labels) and labels[j] == labels[i] + 1:
                    j += 1
                out[d].append((at[i][0], (int(labels[i]) - 1) // 2, at[j - 1][1]))
                i = j
            else:
                i += 1
    return out


def all_spans(base: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The pattern spans and those of the model that overlap none of them, by start and kind."""
    edges = np.array([(a, b) for a, _, b in base], np.int64).reshape(-1, 2)
    free = [s for s in added if not ((edges[:, 0] < s[2]) & (edges[:, 1] > s[0])).any()]
    return sorted([*base, *free])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def find_personal(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (key, base, spans), both ARRAY<STRUCT<kind, s, e>>: what the patterns find, and all."""
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))
    array = lambda rows: pa.array([[{"kind": KINDS[k], "s": a, "e": b} for a, k, b in r] for r in rows], kind_of)
    item = "array<struct<kind:string,s:int,e:int>>"
    return _each(docs, model, key, text, f"base {item}, spans {item}", lambda base, every: [array(base), array(every)])


def digests(docs: DataFrame, model: Model | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (key, n_email, n_ip, n_card, n_phone LONG, base_sha256, spans STRING)."""

    def columns(base, every):
        counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
        sha = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string())
        return [*counts, sha, pa.array(list(map(written, every)), pa.string())]

    return _each(docs, model, key, text, ", ".join([*(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"]), columns)


def _each(docs: DataFrame, model: Model | None, key: str, text: str, fields: str, columns) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    share = spark.sparkContext.broadcast(pack_model(model or train()))
    names = [key, *(f.split()[0] for f in fields.split(", "))]

    def run(batches):
        chain = worker_model(share.value)
        for batch in slices(batches, text):
            of = strings(batch, text)
            base = list(map(base_spans, of))
            every = [all_spans(b, a) for b, a in zip(base, found_by_chain(of, chain))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns(base, every)], names)

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {fields}")
