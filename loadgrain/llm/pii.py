"""Personal data in texts: patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import small_batches, steps

# fixed values: the kinds of the base scan in order, then those that the model adds
BASE_KINDS = ("email", "ip", "card", "phone")
MODEL_KINDS = ("name", "number")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*|[^\w\s]|_")

# The small labelled table: sentences with marked spans, [kind words].
LABELLED = """
My name is [name Maria Lopez] and I live near the station.
Please call [name John Smith] at [number 555-867-5309] before noon.
Dear Mr. [name Patel], your order has been shipped.
The house was built by the river in the old town.
Contact [name Anna Keller] by phone: [number 030 1234567].
Yours sincerely, [name Peter Jones]
Regards, [name Chen Wei]
In 1998 the team won 12 games and lost 4 of them.
Mrs. [name Dubois] will meet Dr. [name Fischer] on Monday.
The meeting on Tuesday was moved to the Grand Hotel in Paris.
Her name is [name Olivia Brown], phone [number 020 7946 0958].
Released under the MIT License in March 2021.
This work is licensed under the GNU General Public License, version 3.
Signed by [name Ahmed Hassan] in the presence of [name Laura Rossi].
You can reach me at [number (212) 555-0147] after five.
Tel: [number 0171 555 0199] or fax: [number 0171 555 0200]
The price rose from 100 to 250 dollars in 2019.
Mr. [name Garcia] and Ms. [name Nowak] signed the contract.
Author: [name Emily Clark]
Chapter 12 describes the results of the second test.
my phone number is [number 415 555 2671] and my office is closed.
The quick brown fox jumps over the lazy dog.
According to the report, sales in Europe fell by 3.5 percent.
Patient: [name Rosa Martin], born in Madrid.
Is this the way to the museum? Yes, it is.
Social security number [number 078-05-1120] was on the form.
SSN: [number 219-09-9999]
It was the best of times, it was the worst of times.
Send it to [name David Kim], 12 Main Street, Springfield.
Of the 40 items, 17 were returned. The rest was sold.
She said that Monday would be fine. They agreed.
The. And. With this, the. Than of it, as in the.
Attn: [name Sofia Petrova] Phone: [number 555 0123]
Version 2.0.1 was published on 2020-05-17 with 31 fixes.
Der Zug kommt um 8 Uhr 30 an. Die Reise dauert lange.
Ich heisse [name Klaus Weber] und wohne in Berlin.
Je m'appelle [name Claire Moreau] et je travaille ici.
Me llamo [name Carlos Ruiz] y vivo en la ciudad.
El tren llega a las 9 y sale a las 10.
Le livre est sur la table. La porte est ouverte.
Aneses heatreble. Thwhat atndat be hesh. Enorin and the thing. Thlyer the for. Eroror on. Reon.
Haored thorer edly. Ererat whly. Oratan it es. Inntin thing on of that. Atbleen threea. That tia.
Whblere, hand tha. Ershst onin es. Erthan, reblean of. Ing was the. Thnt that. Oratin thesntth hathly.
Auouon le. Eauenaux elle. Vièle aile. Ciónrr. De los quell. Esos de. Las en. Der eingeä. Das achlich.
Then Over the hill. Thanonre Thereor was. Is. Was. For. And.
Price | Ndesat | Tieser | Ertion | Thenti
Thwhou, Anorstsh of the. In and To the. At the Re of.
The number 12 and 1034 of 77. In 2004 there were 88 or 90.
24be64439e3e49cf and 4785380592391139 are codes. 152.143.123.131 and 19
"""
LABELS = ["O", *(f"{p}-{k}" for k in MODEL_KINDS for p in "BI")]
IMPOSSIBLE = -1000.0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: from each @ back over its local part, and on over its domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """All base matches that pass, as (start, kind number, end) in code points, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """Capitals become X, small letters x, digits d; runs longer than three are cut to three."""
    s = "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    return re.sub(r"(.)\1{3,}", r"\1\1\1", s)


def possible(word: str) -> bool:
    """Whether a word can be personal data: capitalised, with a digit, or a sign within numbers. All others are O."""
    return word[0].isupper() or word in "()+-./" or any(c.isdigit() for c in word)


def word_features(word: str) -> list[str]:
    """What the model sees of a possible word itself: its shape, end and length, and the word if it is a cue."""
    low = word.lower()
    out = [f"shape={shape(word)}", f"end={shape(word[-2:])}", f"size={min(len(word), 8)}"]
    if low in CUES or not low[0].isalnum():
        out.append(f"word={low}")
    return out


def word_side(word: str) -> str:
    """What the model sees of a word beside or before: a cue or a sign itself, else its class."""
    low = word.lower()
    if low in CUES or not low[0].isalnum():
        return low if low in CUES or low in SIGNS else "sign"
    if any(c.isdigit() for c in word):
        return "0"
    return "X" if word[0].isupper() else "x"


# fixed values: words that tell what comes next
CUES = frozenset(
    "mr mrs ms dr name is am dear regards sincerely by call contact phone tel fax telephone mobile number ssn security "
    "patient author attn signed heisse m'appelle llamo the of and in on a an to version chapter license reach me".split()
)
SIGNS = frozenset(".,:;!?()[]{}+-/|@#\"'")


@dataclass
class Crf:
    """Scores by feature: of the word itself, and of the words at -2, -1 and +1; and of label pairs."""

    own: dict[str, np.ndarray]
    sides: dict[str, np.ndarray]
    move: np.ndarray


def labelled_rows(text: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    """The labelled sentences as words and label numbers."""
    rows = []
    for line in filter(None, text.splitlines()):
        words, labels = [], []
        for part in re.split(r"(\[\w+ [^\]]+\])", line):
            kind = part[1:].split(" ", 1)[0] if part.startswith("[") else ""
            own = WORD.findall(part[len(kind) + 2 : -1] if kind else part)
            words += own
            for i in range(len(own)):
                labels.append(LABELS.index(f"{'I' if i else 'B'}-{kind}") if kind else 0)
        rows.append((words, labels))
    return rows


def sequence_features(words: list[str]) -> list[list[str]]:
    """For each word its own features and those of its neighbours, which carry their place."""
    side = ["edge", "edge", *map(word_side, words), "edge"]
    return [
        [*word_features(w), f"-2:{side[i]}", f"-1:{side[i + 1]}", f"+1:{side[i + 3]}"] for i, w in enumerate(words)
    ]


def train_crf(rows: list[tuple[list[str], list[int]]], penalty: float = 0.02, rounds: int = 80) -> Crf:
    """Maximise the penalised likelihood of the labelled sentences by gradient ascent with adapted rates.

    Expectations come from the forward-backward sums over each sentence. A sentence starts as if behind an O.
    """
    index: dict[str, int] = {}
    data = []
    n = len(LABELS)
    for words, labels in rows:
        found = [np.array([index.setdefault(f, len(index)) for f in fs]) for fs in sequence_features(words)]
        mask = np.where(np.array([possible(w) for w in words])[:, None] | (np.arange(n) == 0), 0.0, IMPOSSIBLE)
        data.append((found, np.array(labels), mask))
    emit, move = np.zeros((len(index), n)), np.zeros((n, n))
    for i, label in enumerate(LABELS):  # I only behind B or I of its kind
        for j, before in enumerate(LABELS):
            if label[0] == "I" and before[1:] != label[1:]:
                move[j, i] = IMPOSSIBLE
    never = move < 0
    seen = [np.full(x.shape, 1e-6) for x in (emit, move)]
    for _ in range(rounds):
        grads = [-penalty * emit, -penalty * move]
        for found, labels, mask in data:
            scores = np.array([emit[f].sum(axis=0) for f in found]) + mask
            ahead, back = np.empty_like(scores), np.zeros_like(scores)
            ahead[0] = move[0] + scores[0]
            for t in range(1, len(found)):
                ahead[t] = scores[t] + _log_sum(ahead[t - 1][:, None] + move, 0)
            for t in range(len(found) - 2, -1, -1):
                back[t] = _log_sum(move + (scores[t + 1] + back[t + 1])[None, :], 1)
            total = _log_sum(ahead[-1], 0)
            p = np.exp(ahead + back - total)
            for t, f in enumerate(found):
                grads[0][f] -= p[t]
                grads[0][f, labels[t]] += 1
                if t:
                    grads[1] -= np.exp(ahead[t - 1][:, None] + move + (scores[t] + back[t])[None, :] - total)
                grads[1][labels[t - 1] if t else 0, labels[t]] += 1
            grads[1][0] -= p[0]
        grads[1][never] = 0
        for x, g, s in zip((emit, move), grads, seen, strict=True):
            s += g * g
            x += 0.3 * g / np.sqrt(s)
    sides = {f: emit[i] for f, i in index.items() if f[:3] in ("-2:", "-1:", "+1:")}
    return Crf({f: emit[i] for f, i in index.items() if f not in sides}, sides, move)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    high = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - high).sum(axis=axis)) + np.squeeze(high, axis)


def viterbi(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best labels of many sequences at once; ``scores`` is (place, sequence, label), padded behind ``lengths``."""
    best = scores[0] + move[0]
    back = np.zeros(scores.shape, np.int8)
    n = scores.shape[2]
    for t in range(1, len(scores)):
        ways = best[:, :, None] + move[None]
        back[t] = ways.argmax(axis=1)
        new = np.take_along_axis(ways, back[t][:, None, :].astype(np.int64), 1)[:, 0] + scores[t]
        on = t < lengths
        best = np.where(on[:, None], new, best)
        back[t][~on] = np.arange(n)
    out = np.zeros(scores.shape[:2], np.int8)
    out[-1] = best.argmax(axis=1)
    rows = np.arange(scores.shape[1])
    for t in range(len(scores) - 1, 0, -1):
        out[t - 1] = back[t][rows, out[t]]
    return out


class _Words(dict):
    """Numbers words as they come; keeps their own scores and how their neighbours see them."""

    def __init__(self, model: Crf, codes: dict[str, int]):
        self.model, self.codes = model, codes
        self.own = np.zeros((1 << 16, len(LABELS)))
        self.side, self.can = np.zeros(1 << 16, np.int16), np.zeros(1 << 16, bool)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.own):
            self.own, self.side, self.can = (np.concatenate([x, np.zeros_like(x)]) for x in (self.own, self.side, self.can))
        self[word] = at
        self.side[at] = self.codes.get(word_side(word), 1)
        self.can[at] = possible(word)
        if self.can[at]:
            self.own[at] = sum((self.model.own[f] for f in word_features(word) if f in self.model.own), np.zeros(len(LABELS)))
        return at


class Tagger:
    """Decodes the words of whole texts.

    A word that can't be personal data is O for certain, so the words between two such form a chain of their
    own: its best labels are those of the whole text's best labels. Only these chains are decoded.
    """

    def __init__(self, model: Crf):
        self.model = model
        names = sorted({f[3:] for f in model.sides} - {"edge"})
        self.codes = {f: i for i, f in enumerate(["edge", "never seen", *names])}
        zero = np.zeros(len(LABELS))
        self.sides = [
            np.array([model.sides.get(f"{place}:{f}", zero) for f in self.codes]) for place in ("-2", "-1", "+1")
        ]
        self.words = _Words(model, self.codes)

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Spans of the model's kinds, as (start, kind number, end), of each text."""
        if len(self.words) > 100_000:
            self.words = _Words(self.model, self.codes)
        found = [WORD.findall(t) for t in texts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        total = int(size.sum())
        if not total:
            return out
        which = np.fromiter(map(self.words.__getitem__, itertools.chain.from_iterable(found)), np.int64, total)
        words = self.words
        text = np.repeat(np.arange(len(texts)), size)
        at = np.flatnonzero(words.can[which])
        scores = words.own[which[at]]
        for table, step in zip(self.sides, (-2, -1, 1), strict=True):
            there = np.clip(at + step, 0, total - 1)
            same = (there == at + step) & (text[there] == text[at])
            scores += table[np.where(same, words.side[which[there]], 0)]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (np.diff(text[at]) > 0)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(at)))
        # an O follows, unless the text ends
        ends = at[first + length - 1] + 1
        follows = (ends < total) & (text[np.minimum(ends, total - 1)] == text[at[first]])
        scores[(first + length - 1)[follows]] += self.model.move[:, 0]
        labels = self._decode(scores, first, length)
        hits = np.flatnonzero(labels)
        starts = np.cumsum(size) - size
        for i in np.unique(text[at[hits]]):
            places = [m.span() for m in WORD.finditer(texts[i])]
            own = out[i]
            before = -2
            for h in hits[text[at[hits]] == i]:
                name, nth = LABELS[labels[h]], int(at[h] - starts[i])
                kind = len(BASE_KINDS) + MODEL_KINDS.index(name[2:])
                if name[0] == "I" and before == nth - 1 and own and own[-1][1] == kind:
                    own[-1] = (own[-1][0], kind, places[nth][1])
                else:
                    own.append((places[nth][0], kind, places[nth][1]))
                before = nth
        return out

    def _decode(self, scores: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The best labels of all chains, decoded side by side in order of length."""
        out = np.zeros(len(scores), np.int8)
        order = np.argsort(length, kind="stable")
        at = 0
        while at < len(order):
            n = min(max(int(50_000 // length[order[at]]), 1), len(order) - at)
            while n > 1 and n * length[order[at + n - 1]] > 200_000:
                n //= 2
            some = order[at : at + n]
            size = length[some]
            place = first[some][None, :] + np.minimum(np.arange(size.max())[:, None], size[None, :] - 1)
            labels = viterbi(scores[place], size, self.model.move)
            inner = np.arange(size.max())[:, None] < size[None, :]
            out[place[inner]] = labels[inner]
            at += n
        return out


def apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that none of the others, sorted by start, overlaps."""
    starts = [a for a, _, _ in others]
    reach = list(itertools.accumulate((b for _, _, b in others), max))
    out = []
    for span in spans:
        i = bisect.bisect_left(starts, span[2])
        if not i or reach[i - 1] <= span[0]:
            out.append(span)
    return out


SPANS = "array<struct<start:long,rank:int,end:long,kind:string>>"


def find_personal_data(docs: DataFrame, labelled: str = LABELLED) -> DataFrame:
    """The columns of ``docs`` with ``base`` and ``added``: spans (start, rank, end, kind) in code points, sorted.

    ``base`` are the matches of the patterns. ``added`` are names and numbers that a linear-chain conditional random
    field finds from word shapes, cues and their neighbours; it is trained here from ``labelled``, a small table
    of marked sentences. A span that a base span overlaps is left out. Texts of any length are decoded whole.

    One pass without a shuffle. A null or empty text has no spans, repeated rows and null ids are rows like any
    other, an empty table gives no rows. Columns named ``base`` or ``added`` in ``docs`` are replaced.
    """
    docs = small_batches(docs).drop("base", "added")
    schema = docs.limit(0).withColumns({c: F.lit(None).cast(SPANS) for c in ("base", "added")}).schema
    return docs.mapInArrow(_finder(docs, labelled), schema)


def _finder(docs: DataFrame, labelled: str = LABELLED) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``find_personal_data`` does with batches of ``docs``."""
    model = train_crf(labelled_rows(labelled))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    names = (*BASE_KINDS, *MODEL_KINDS)

    def listed(rows):
        return pa.array(
            [[{"start": a, "rank": k, "end": b, "kind": names[k]} for a, k, b in row] for row in rows], spans
        )

    def find(batches):
        tagger = Tagger(shared.value)
        for batch in steps(batches):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = tagger.spans(texts)
            more = [apart(own, found) if own and found else own for own, found in zip(more, base, strict=True)]
            yield batch.append_column("base", listed(base)).append_column("added", listed(more))

    spans = pa.list_(
        pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())])
    )
    return find


def mask(text: str, spans: list) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first counts."""
    out, at = [], 0
    for start, _, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def united(spans: list) -> list:
    """Sorted spans with those that overlap made one, of the first one's kind."""
    out = []
    for start, rank, end, kind in spans:
        if out and start < out[-1][2]:
            out[-1] = (*out[-1][:2], max(end, out[-1][2]), out[-1][3])
        else:
            out.append((start, rank, end, kind))
    return out


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """The same columns and rows with every span of ``find_personal_data`` masked in ``text``; a null text stays null.

    Overlapping spans are masked as one, so that nothing of the later one is left. One Python worker finds and masks.
    """
    find = _finder(small_batches(docs))
    at, base = docs.columns.index("text"), len(docs.columns)

    def change(batches):
        for batch in find(batches):
            texts = []
            rows = zip(*(batch.column(c).to_pylist() for c in (at, base, base + 1)), strict=True)
            for text, own, more in rows:
                spans = sorted((x["start"], x["rank"], x["end"], x["kind"]) for x in own + more)
                texts.append(mask(text, united(spans)) if spans else text)
            field = batch.schema.field(at)
            yield batch.set_column(at, field, pa.array(texts, field.type)).select(list(range(base)))

    return docs.mapInArrow(change, docs.schema)
