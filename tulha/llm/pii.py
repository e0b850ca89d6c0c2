"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The field labels whole segments. A text's islands are runs of tokens that hold a digit or
an at sign (also spelled in brackets), with at most ``GAP`` characters between them; all other words are outside. A
segment is one to ``LONGEST`` tokens of an island with a kind, or one token that is no
personal data. The score of a segment is a weighted sum of features of the whole span
(its shape, count of digits, checksum, separators, the characters around it). Dynamic
programming over segment ends, bounded by LONGEST, chooses boundaries and kinds of an
island together (Viterbi), and the same recursion in the log domain gives the gradients
of training.

The weights are learned from islands labelled by the fixed patterns and from copies of them
in which the spans are written in other ways (``changed``: other separators, brackets, no
plus sign, a spelled at sign) or replaced by what only looks like them (``unlike``: dates,
versions, numbers that fail their check). So spans beyond the patterns are added where the
field prefers them by ``MARGIN``: their kind is one of the four, and the patterns' own
spans always stay. Training takes at most ``SAMPLE`` islands of at most about
``SAMPLE_TEXTS`` different texts, none above ``EXAMPLE`` characters, documented bounds. An island is decoded whole,
however long. Texts are read whole, once to train and once
to find; nothing is shuffled but the sampled texts and their islands.

Defined results: null text is empty text; a text without spans has the hash of the empty
string; added spans never touch the patterns' spans; with no labelled island nothing is
added; repeated rows give repeated results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.llm.common import column_list, map_batches, some_texts, texts_of

KINDS = ("email", "ip", "card", "phone")
#: What the patterns of the four kinds accept. The quantifiers give nothing
#: back where giving back could not help, so very long runs take linear time.
EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]++(?:@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?+"
)
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A token: letters, digits and marks inside; marks at the ends are left out.
INSIDE = re.compile(r"[A-Za-z0-9@._%+()-]++")
SEED = re.compile(r"[0-9@]|[(\[]at[)\]]")
GAP = 3
LONGEST = 6
STRIDE = 64  # segment ends whose features are held at a time
SAMPLE = 1000
SAMPLE_TEXTS = 20_000
EXAMPLE = 4000  # characters; longer islands are no examples
ROUNDS = 12
RATE = 0.5
DECAY = 1e-3
#: Log odds by which an added segment must beat the reading as no personal data.
MARGIN = 2.0

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and then by kind."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text) if "@" in m[0]]
    if SEED.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if _is_ip(m[0])]
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(only_digits(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


Token = tuple[int, int]


def _word(text: str, begin: int, least: int) -> Token | None:
    """The run of INSIDE characters around a place, from ``least`` on, without marks at its
    ends; also where the run ends in marks."""
    while begin > least and INSIDE.match(text[begin - 1]):
        begin -= 1
    found = INSIDE.match(text, begin)
    end = found.end() if found else begin
    while begin < end and text[begin] in ".-)":
        begin += 1
    if begin + 1 < end and text[begin] in "+(" and text[begin + 1] in ".+()-":
        begin += 1
    last = end
    while last > begin and not (text[last - 1].isalnum() or text[last - 1] == ")"):
        last -= 1
    return (begin, last) if begin < last else None


def _spelled(text: str, begin: int, end: int, least: int) -> Token | None:
    """An address whose at sign, from ``begin`` to ``end``, is spelled in brackets."""
    left, right = begin, end
    if left > least and text[left - 1] == " ":
        left -= 1
    if text[right : right + 1] == " ":
        right += 1
    name = _word(text, left, least)
    host = INSIDE.match(text, right)
    if name is None or name[1] < left or host is None:
        return None
    last = host.end()
    while last > right and not text[last - 1].isalnum():
        last -= 1
    return (name[0], last) if last > right else None


def islands(text: str) -> Iterator[list[Token]]:
    """Runs of tokens with a digit or an at sign; a spelled at sign joins its neighbours."""
    tokens: list[Token] = []
    at = 0
    while (seed := SEED.search(text, at)) is not None:
        spelled = len(seed[0]) > 1
        begin, end = seed.span()
        # The name before a spelled at sign may be a token already, as it holds a digit.
        joins = spelled and tokens and begin - tokens[-1][1] <= 1
        least = tokens[-1][0] if joins else at
        found = _spelled(text, begin, end, least) if spelled else _word(text, begin, least)
        run = INSIDE.match(text, begin)
        at = max(end, run.end() if run else end, found[1] if found else 0)
        if found is None:
            continue
        if joins:
            tokens.pop()
        if tokens and found[0] - tokens[-1][1] > GAP:
            yield tokens
            tokens = []
        tokens.append(found)
    if tokens:
        yield tokens


def shape(text: str) -> str:
    """Runs of digits as 0, of letters as a, other characters as they are."""
    return re.sub("[0-9]+", "0", re.sub("[^\\W\\d_]+", "a", text))


SPELLED = re.compile(r" ?[(\[]at[)\]] ?")


def describe(text: str, island: list[Token], first: int, last: int) -> list[str]:
    """Names of the features of the segment of tokens first to last, without its kind."""
    begin, end = island[first][0], island[last][1]
    span = text[begin:end]
    digits = only_digits(span)
    letters = sum(c.isalpha() for c in span)
    before = text[max(0, begin - 1) : begin]
    after = text[end : end + 1]
    out = [
        "bias", f"digits={min(len(digits), 20)}", f"letters={min(letters, 3)}",
        f"at={span.count('@')}", f"dots={min(span.count('.'), 4)}", f"tokens={last - first + 1}",
        f"before={shape(before)}", f"after={shape(after)}",
        f"left={shape(text[max(0, begin - 4) : begin])}", f"right={shape(text[end : end + 4])}",
        f"first={shape(span[:1])}", f"last={shape(span[-1:])}",
        f"spaces={min(span.count(' '), 4)}", f"dashes={min(span.count('-'), 4)}",
        f"round={min(span.count('('), 2)}{min(span.count(')'), 2)}",
        f"wide={any(c.isspace() and c != ' ' for c in span)}",
    ]
    groups = re.findall("[0-9]+", span)
    if letters == 0 and len(groups) <= LONGEST:
        out.append(f"groups={'-'.join(str(min(len(g), 9)) for g in groups)}")
        out.append(f"marks={'|'.join(sorted(set(re.split('[0-9]+', span[1:-1])) - {''}))}")
    out.append(f"zeros={span[:2] == '00'} plus={span[:1] == '+'} {9 <= len(digits) <= 15}")
    if letters:
        out.append(f"spelled={len(re.findall(SPELLED, span))} {'.' in span[-8:]}")
    if len(digits) >= 9:
        out.append(f"luhn={luhn(digits)} {12 <= len(digits) <= 19} {letters == 0}")
    parts = span.split(".")
    if len(parts) == 4 and not letters:
        out.append(f"quad={all(p.isdecimal() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)}")
    if span.count("@") == 1:
        left, right = span.split("@")
        out.append(f"mail={bool(left)}{'.' in right.strip('.')}{' ' in span}")
    return out


Lattice = list[tuple[int, int, list[str]]]


def lattice(text: str, island: list[Token], begin: int = 0, till: int | None = None) -> Lattice:
    """(first, end, features) of every segment that may be personal data and ends after
    token ``begin`` and not after ``till``, by end."""
    return [
        (first, end, describe(text, island, first, end - 1))
        for end in range(begin + 1, (len(island) if till is None else till) + 1)
        for first in range(max(0, end - LONGEST), end)
    ]


@dataclass
class Model:
    numbers: dict[str, int]
    weights: np.ndarray  # kinds x features

    def scores(self, segments: Lattice) -> np.ndarray:
        """Segments x kinds; no personal data has score 0."""
        out = np.empty((len(segments), len(KINDS)))
        for k, (_, _, names) in enumerate(segments):
            found = [self.numbers[n] for n in names if n in self.numbers]
            out[k] = self.weights[:, found].sum(axis=1)
        return out

    def decode(self, text: str, island: list[Token]) -> list[Span]:
        """Segments of the best reading of an island that win by MARGIN.

        The state moves along the whole island; only STRIDE ends have their features at a
        time, so an island may be as long as a text.
        """
        best = [0.0]
        back: list[tuple[int, int, float]] = [(0, -1, 0.0)]
        for at in range(0, len(island), STRIDE):
            segments = lattice(text, island, at, min(len(island), at + STRIDE))
            scores = self.scores(segments)
            kinds, values = scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist()
            for (first, end, _), kind, score in zip(segments, kinds, values):
                if end == len(best):  # the first segment with this end
                    best.append(best[end - 1])
                    back.append((end - 1, -1, 0.0))
                if best[first] + score > best[end]:
                    best[end], back[end] = best[first] + score, (first, kind, score)
        out, end = [], len(island)
        while end:
            first, kind, score = back[end]
            if kind >= 0 and score >= MARGIN:
                out.append((KINDS[kind], island[first][0], island[end - 1][1]))
            end = first
        return out[::-1]


def gradient(
    scores: np.ndarray, segments: Lattice, count: int
) -> tuple[np.ndarray, float]:
    """Probability of each segment and kind in an island, and the log of the sum of all
    readings: forward and backward over segment ends."""
    ahead = np.full(count + 1, -math.inf)
    behind = np.full(count + 1, -math.inf)
    ahead[0] = behind[count] = 0.0
    total = np.logaddexp.reduce(scores, axis=1)
    by_end: list[list[int]] = [[] for _ in range(count + 1)]
    by_first: list[list[int]] = [[] for _ in range(count + 1)]
    for number, (first, end, _) in enumerate(segments):
        by_end[end].append(number)
        by_first[first].append(number)
    for at in range(1, count + 1):
        ways = [ahead[at - 1]] + [ahead[segments[s][0]] + total[s] for s in by_end[at]]
        ahead[at] = np.logaddexp.reduce(ways)
    for at in range(count - 1, -1, -1):
        ways = [behind[at + 1]] + [behind[segments[s][1]] + total[s] for s in by_first[at]]
        behind[at] = np.logaddexp.reduce(ways)
    around = np.array([ahead[a] + behind[b] for a, b, _ in segments])
    return np.exp(scores + around[:, None] - ahead[count]), float(ahead[count])


def fit(examples: list[tuple[str, list[Token], list[Span]]]) -> Model:
    """Maximum likelihood by AdaGrad with weight decay over the islands, in given order."""
    numbers: dict[str, int] = {}
    ready = []
    for text, island, gold in examples:
        segments = lattice(text, island)
        wanted = {(a, b): KINDS.index(k) for k, a, b in gold}
        target = np.zeros((len(segments), len(KINDS)))
        rows = []
        for s, (first, end, names) in enumerate(segments):
            kind = wanted.get((island[first][0], island[end - 1][1]))
            if kind is not None:
                target[s, kind] = 1
            rows.append([numbers.setdefault(n, len(numbers)) for n in names])
        if target.sum() == len(gold):  # else a span's ends lie inside tokens
            ready.append((segments, len(island), target, rows))
    model = Model(numbers, np.zeros((len(KINDS), len(numbers))))
    squares = np.full_like(model.weights, 1e-8)
    for _ in range(ROUNDS):
        for segments, count, target, rows in ready:
            scores = np.array([model.weights[:, r].sum(axis=1) for r in rows])
            error = target - gradient(scores, segments, count)[0]
            for r, e in zip(rows, error):
                if np.abs(e).max() > 1e-3:
                    step = e[:, None] - DECAY * model.weights[:, r]
                    squares[:, r] += step**2
                    model.weights[:, r] += RATE * step / np.sqrt(squares[:, r])
    return model


def _digits(draw: random.Random, count: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(count))


def _pieces(digits: str, sizes: list[int]) -> list[str]:
    ends = list(itertools.accumulate(sizes))
    return [digits[b - a : b] for a, b in zip(sizes, ends)]


def _checked(draw: random.Random, count: int, valid: bool) -> str:
    """Digits that pass the check of card numbers, or fail it."""
    body = _digits(draw, count - 1)
    last = next(c for c in "0123456789" if luhn(body + c))
    return body + (last if valid else str((int(last) + draw.randint(1, 9)) % 10))


def changed(kind: str, span: str, draw: random.Random) -> str:
    """A span of the kind as people write it too, beyond what the patterns find."""
    digits = only_digits(span)
    if kind == "email":
        return draw.choice([" (at) ", "(at)", " [at] ", "[at]"]).join(span.split("@"))
    if kind == "ip":
        return draw.choice(["[.]", "(.)"]).join(span.split("."))
    if kind == "card":
        sizes = [4, 4, 4, 4] if len(digits) == 16 else [4, 6, len(digits) - 10]
        return draw.choice([".", "/", " - ", "  "]).join(_pieces(digits, sizes))
    a, b, c = _pieces(digits[-10:].rjust(10, "2"), [3, 3, 4])
    mark = draw.choice("-. ")
    return draw.choice(
        [f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}{mark}{b}{mark}{c}", f"00{digits[:2]} {a[1:]} {b}{c}",
         f"001{mark}{a}{mark}{b}{mark}{c}", f"0{a}/{b}{c}"]
    )


def unlike(draw: random.Random) -> str:
    """What looks like personal data and is none: numbers, dates, versions, names."""
    n = lambda low, high: draw.randint(low, high)
    card = _checked(draw, 16, valid=False)
    return draw.choice(
        [f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 31):02}", f"{n(1, 28)}/{n(1, 12)}/{n(1900, 2099)}",
         f"{n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}", f"{n(0, 9)}.{n(0, 20)}.{n(0, 99)}", f"{n(1, 999)},{n(0, 999):03}.{n(0, 99):02}",
         f"{n(256, 999)}.{n(0, 255)}.{n(256, 999)}.{n(0, 255)}", draw.choice([" ", "-", "."]).join(_pieces(card, [4] * 4)),
         f"user{n(1, 99)}@localhost", f"@name{n(1, 999)}", f"{n(1, 9)} (at) {n(1, 9)}", f"{n(100, 999)}-{n(1000, 9999)}",
         f"{n(1, 99)} {n(1, 99)} {n(1, 99)}", f"ISBN {_digits(draw, 3)}-{n(0, 9)}-{_digits(draw, 5)}-{_digits(draw, 3)}-{n(0, 9)}",
         f"({n(1, 99)})", f"{n(1990, 2030)} {n(1990, 2030)} {n(1990, 2030)}", f"no. {_digits(draw, n(4, 8))}",
         f"{n(1, 9)}-{n(10, 99)}-{n(100, 999)}", f"v{n(1, 9)}.{n(0, 9)}.{n(0, 9)}.{n(0, 9)}-rc{n(1, 9)}"]
    )


Example = tuple[str, list[Token], list[Span]]


def copies(example: Example, draw: random.Random) -> Iterator[Example]:
    """The example with its spans written in other ways, and with unlike ones in their place."""
    text, _, gold = example
    if not gold:
        return
    for change in (changed, changed, lambda kind, span, draw: unlike(draw)):
        out, spans, at = "", [], 0
        for kind, a, b in gold:
            if a < at:
                continue  # overlaps the span before
            new = change(kind, text[a:b], draw)
            out += text[at:a]
            if change is changed:
                spans.append((kind, len(out), len(out) + len(new)))
            out += new
            at = b
        out += text[at:]
        for island in islands(out):
            low, high = island[0][0], island[-1][1]
            yield out, island, [s for s in spans if s[1] < high and s[2] > low]


def train(docs: DataFrame) -> Model | None:
    """Learn from islands labelled by the patterns and from changed copies of them; None
    without a labelled span."""
    rows = some_texts(docs, SAMPLE_TEXTS, 3)

    def work(batch: pa.RecordBatch) -> dict:
        out = []
        for text in texts_of(batch):
            gold = base_spans(text)
            for island in islands(text):
                begin, end = max(0, island[0][0] - 8), island[-1][1] + 8
                own = [(k, a - begin, b - begin) for k, a, b in gold if a >= island[0][0] and b <= island[-1][1]]
                tokens = [(a - begin, b - begin) for a, b in island]
                out.append(json.dumps([text[begin:end], tokens, own]))
        return {"island": [x for x in out if len(x) <= EXAMPLE]}

    sample = map_batches(rows, "island string", work)
    sample = sample.distinct().orderBy(F.xxhash64("island"), "island").limit(SAMPLE)

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        examples = [json.loads(x) for x in sorted(group["island"])]
        if not any(gold for _, _, gold in examples):
            return pd.DataFrame({"name": [], "w": []}, dtype=object)
        draw = random.Random(len(examples))
        model = fit(examples + [c for e in examples for c in copies(e, draw)])
        names = sorted(model.numbers, key=model.numbers.get)
        return pd.DataFrame({"name": names, "w": model.weights.T.tolist()})

    one = sample.select("island", F.lit(1).alias("one")).groupBy("one")
    found = one.applyInPandas(learn, "name string, w array<double>").collect()
    if not found:
        return None
    weights = np.array([r["w"] for r in found]).T
    return Model({r["name"]: k for k, r in enumerate(found)}, weights)


def all_spans(text: str, base: list[Span], model: Model | None) -> list[Span]:
    """The patterns' spans and those the field adds, by start and then by kind."""
    if model is None:
        return base
    added = []
    for island in islands(text):
        low, high = island[0][0], island[-1][1]
        near = [(a, b) for _, a, b in base if a < high and b > low]
        if len(near) == 1 and near[0][0] <= low and near[0][1] >= high:
            continue  # nothing left to add
        for kind, a, b in model.decode(text, island):
            if not any(a < d and b > c for c, d in near):
                added.append((kind, a, b))
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the patterns, hash of their spans, all spans, n_spans, n_added."""
    model = train(docs)

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f"n_{k}": [] for k in KINDS}
        out |= {"doc_id": column_list(batch, "doc_id"), "base_sha256": [], "spans": [], "n_spans": [], "n_added": []}
        for text in texts_of(batch):
            base = base_spans(text)
            spans = all_spans(text, base, model)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
            out["n_spans"].append(len(spans))
            out["n_added"].append(len(spans) - len(base))
        return out

    kind = dict(docs.dtypes)["doc_id"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    schema = f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_spans bigint, n_added bigint"
    return map_batches(docs.select("doc_id", "text"), schema, work)
