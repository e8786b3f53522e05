"""Personal data in texts: fixed patterns, and a character tagger that finds what they miss.

The patterns give the base spans of four kinds: e-mail addresses, IP addresses, card numbers that pass
Luhn's test, and phone numbers. Each takes the leftmost matches without overlap and drops those that
fail their test; all are found in time linear in the text, whatever it holds.

The tagger, a bidirectional LSTM over characters under a CRF (``bilstm_crf``), is trained from labelled
spans: windows around base spans of a bounded sample of documents, some with the span rewritten in a
way that people write it and the patterns do not take, and windows around other digits and signs.

Every kind holds a digit or an ``@``. The characters within ``REACH`` of one form regions, which are
covered by windows that overlap by half. The tagger decodes each window; what the windows say of a
place, their log probabilities, is averaged with less weight towards a window's edge, and the best
valid path of tags over the whole region settles it, so that windows that disagree, and spans longer
than a window, come to one result. Its spans are added if they are sure enough, hold what their kind
cannot be without, and touch no base span.

Nulls and oddities: null and empty texts hold nothing. Rows that repeat a doc_id are rows of their own.
Without any base span in the sample there is no tagger, and base spans are all. Positions count code
points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rainfold.llm.bilstm_crf import OUTSIDE, Tagger, allowed, best_paths, character_ids
from rainfold.llm.storage import discard, stored

# The kinds in their order, windows and their step, how far a region reaches, the least
# mean probability of an added span, and the bounds of the training sample.
KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP, REACH = 80, 40, 24
SURE = 0.9
SAMPLE_DOCS, SPAN_WINDOWS, OTHER_WINDOWS = 10_000, 2_400, 1_600
_TOGETHER = 256
# The patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9]+")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for domain in _DOMAIN.finditer(text):
        start = domain.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            yield start, domain.end()
            done = domain.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts = [m.span() for m in _DIGITS.finditer(text, *chain.span())]
        for i in range(0, len(parts) - 3, 4):
            values = [text[a:b].lstrip("0") or "0" for a, b in parts[i : i + 4]]
            if all(len(v) <= 3 and int(v) <= 255 for v in values):
                yield parts[i][0], parts[i + 3][1]


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _NUMBER.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and passes_luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in match.group()) <= 15:
            yield match.span()


_FINDERS = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    return [(kind, a, b) for kind, find in zip(KINDS, _FINDERS) for a, b in find(text)]


def regions(text: str) -> list[tuple[int, int]]:
    """Ranges of the characters that are near a digit or an ``@``."""
    out: list[tuple[int, int]] = []
    for match in _SIGN.finditer(text):
        start, end = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], end
        else:
            out.append((start, end))
    return out


def windows_of(start: int, end: int) -> list[int]:
    """Where the windows over a region start; a short region stands in the middle of one."""
    if end - start <= WINDOW:
        return [start - (WINDOW - (end - start)) // 2]
    return [*range(start, end - WINDOW, STEP), end - WINDOW]


def _ids(text: str, start: int, end: int) -> np.ndarray:
    """Characters of a range that may reach beyond the text."""
    inside = text[max(0, start) : end]
    codes = np.frombuffer(inside.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(end - start, OUTSIDE, np.uint8)
    first = max(0, -start)
    out[first : first + len(codes)] = character_ids(codes)
    return out


_EDGE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def tagged(texts: list[str], tagger: Tagger) -> list[list[tuple[str, int, int, float]]]:
    """Spans that the tagger finds in each text, with their probabilities."""
    found: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    wanted = [(t, a, b) for t, text in enumerate(texts) for a, b in regions(text)]
    # Regions of like lengths go together.
    wanted.sort(key=lambda region: region[2] - region[1])
    at = 0
    while at < len(wanted):
        room = max(1, _TOGETHER * WINDOW // max(WINDOW, wanted[at][2] - wanted[at][1]))
        part = wanted[at : at + room]
        at += len(part)
        for (t, start, _), spans in zip(part, _settled(part, texts, tagger)):
            found[t] += [(kind, start + a, start + b, p) for kind, a, b, p in spans]
    return [sorted(spans, key=lambda s: s[1]) for spans in found]


def _settled(
    part: list[tuple[int, int, int]], texts: list[str], tagger: Tagger
) -> list[list[tuple[str, int, int, float]]]:
    lengths = np.array([b - a for _, a, b in part])
    tags = len(tagger.allowed)
    sums = np.zeros((len(part), lengths.max(), tags), np.float32)
    weights = np.zeros((len(part), lengths.max(), 1), np.float32)
    places = [(r, t, w, a) for r, (t, a, b) in enumerate(part) for w in windows_of(a, b)]
    for first in range(0, len(places), _TOGETHER):
        some = places[first : first + _TOGETHER]
        ids = np.stack([_ids(texts[t], w, w + WINDOW) for _, t, w, _ in some])
        for (r, _, w, a), said in zip(some, tagger.log_marginals(ids)):
            low, high = max(0, a - w), min(WINDOW, lengths[r] + a - w)
            edge = _EDGE[low:high, None]
            sums[r, w + low - a : w + high - a] += edge * said[low:high]
            weights[r, w + low - a : w + high - a] += edge
    scores = sums / np.maximum(weights, 1e-9)
    paths = best_paths(scores, lengths, tagger.allowed)
    return [_spans(p[:n], s[:n]) for p, s, n in zip(paths, scores, lengths)]


def _spans(path: np.ndarray, scores: np.ndarray) -> list[tuple[str, int, int, float]]:
    kind = (path - 1) // 2
    opens = (path > 0) & ((path % 2 == 1) | (np.append(-1, kind[:-1]) != kind))
    out = []
    for a in np.flatnonzero(opens).tolist():
        b = a + 1
        while b < len(path) and path[b] == 2 + 2 * kind[a]:
            b += 1
        sure = float(np.exp(scores[np.arange(a, b), path[a:b]].mean()))
        out.append((KINDS[kind[a]], a, b, sure))
    return out


def is_possible(kind: str, inside: str) -> bool:
    """Whether a span holds what its kind cannot be without."""
    if kind == "email":
        return "@" in inside[1:-1]
    parts = _DIGITS.findall(inside)
    digits = "".join(parts)
    if kind == "ip":
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and passes_luhn(digits)
    return 7 <= len(digits) <= 15


def added_spans(text: str, base: list[Span], found: list[tuple[str, int, int, float]]) -> list[Span]:
    """What the tagger adds to the base spans of a text."""
    taken = sorted((a, b) for _, a, b in base)
    out, at = [], 0
    for kind, a, b, sure in found:
        while a < b and text[a].isspace():
            a += 1
        while a < b and text[b - 1].isspace():
            b -= 1
        if sure < SURE or not is_possible(kind, text[a:b]):
            continue
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        # Base spans of different kinds can overlap, so those further on are looked at, too.
        if any(c < b and d > a for c, d in taken[max(0, at - len(KINDS)) : at + 1]):
            continue
        out.append((kind, a, b))
    return out


def _variants(kind: str, text: str, rng: np.random.Generator) -> str:
    """A base span's text as people write it outside the patterns."""
    pick = lambda *ways: ways[rng.integers(len(ways))]
    digits = "".join(_DIGITS.findall(text))
    if kind == "email":
        name, _, host = text.partition("@")
        return pick(f"{name} @ {host}", f"{name} @{host}", f"{name}[@]{host}", f"{name}(@){host}")
    if kind == "ip":
        return text.replace(".", pick(" . ", "[.]", ". "))
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return pick(".", "/", "_", "  ", " - ").join(groups)
    area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return pick(
        f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}",
        f"00{digits[:-10]} {area} {first} {last}", f"+{digits[:-10]}/{area}/{first}/{last}",
    )


def _example(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One training window: its characters and tags, with the spans rewritten now and then."""
    out, marks, done = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < done:
            continue
        out += text[done:a]
        inside = text[a:b]
        if 0 < a and b < len(text) and rng.random() < 0.4:
            inside = _variants(kind, inside, rng)
        marks.append((KINDS.index(kind), len(out), len(out) + len(inside)))
        out, done = out + inside, b
    out += text[done:]
    tags = np.zeros(max(WINDOW, len(out)), np.int64)
    for kind, a, b in marks:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    # A rewritten window that grew is cut so that its middle stays.
    first = max(0, (len(out) - WINDOW) // 2)
    return _ids(out, first, first + WINDOW), tags[first : first + WINDOW]


def _window_rows(text: str) -> Iterator[tuple[bool, str, str]]:
    """Windows to learn from: around each base span, and around up to three other signs."""
    base = base_spans(text)

    def window(start: int) -> tuple[str, str]:
        start = max(0, min(start, len(text) - WINDOW))
        end = start + WINDOW
        inside = [
            (kind, max(a, start) - start, min(b, end) - start)
            for kind, a, b in base
            if a < end and b > start
        ]
        return text[start:end], ",".join(f"{k}:{a}:{b}" for k, a, b in inside)

    for _, a, b in base:
        # The place within the window differs from span to span.
        yield True, *window(a - (7 * a + b) % max(1, WINDOW - min(WINDOW, b - a)))
    near = sorted((a, b) for _, a, b in base)
    others, last = 0, -WINDOW
    for match in _SIGN.finditer(text):
        at = match.start()
        if at >= last + WINDOW and not any(a - 1 <= at <= b for a, b in near):
            yield False, *window(at - 3 * at % WINDOW)
            others, last = others + 1, at
            if others == 3:
                return


@dataclass
class Labelled:
    """Windows and tags."""

    ids: np.ndarray
    tags: np.ndarray


def labelled_windows(docs: DataFrame) -> Labelled:
    """A bounded sample of labelled windows, the same for the same rows."""
    spark = docs.sparkSession
    paths: list[str] = []
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            rows = []
            for text in texts.filter(pc.match_substring_regex(texts, "[0-9@]")).to_pylist():
                rows += _window_rows(text)
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.bool_(), pa.string(), pa.string()))],
                names=["has_span", "window", "spans"],
            )

    some = docs.where(f"text is not null and pmod(xxhash64(doc_id, text), 1000000) < {share * 1e6}")
    rows = stored(
        some.select("text").mapInArrow(cut, "has_span boolean, window string, spans string"),
        "windows", paths,
    )
    kept = []
    for has, most in ((True, SPAN_WINDOWS), (False, OTHER_WINDOWS)):
        part = rows.where(F.col("has_span") == has)
        kept += part.orderBy(F.xxhash64("window", "spans"), "window", "spans").limit(most).collect()
    discard(spark, *paths)
    rng = np.random.default_rng(3)
    examples = []
    for row in kept:
        marks = [m.split(":") for m in row["spans"].split(",") if m]
        spans = [(kind, int(a), int(b)) for kind, a, b in marks]
        examples.append(_example(row["window"], spans, rng))
    ids = np.array([i for i, _ in examples], dtype=np.uint8).reshape(-1, WINDOW)
    return Labelled(ids, np.array([t for _, t in examples], dtype=np.int64).reshape(-1, WINDOW))


def fit(docs: DataFrame) -> Tagger | None:
    """A tagger trained on the base spans of a bounded sample, None without any span in it."""
    labelled = labelled_windows(docs)
    if not labelled.tags.any():
        return None
    return Tagger(len(KINDS)).fit(labelled.ids, labelled.tags)


_FOUND = "doc_id long, spans array<struct<kind: string, start: int, end: int, base: boolean>>"
_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]
)


def personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id and spans of every row, by kind and start; ``base`` tells those of the patterns."""
    held = docs.sparkSession.sparkContext.broadcast(tagger)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = held.value
        for batch in batches:
            column = batch.column("text")
            hit = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
            rows = np.flatnonzero(hit.to_numpy(zero_copy_only=False)).tolist()
            texts = column.filter(hit).to_pylist()
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            more = tagged(texts, tagger) if tagger else [[] for _ in texts]
            for row, text, found in zip(rows, texts, more):
                base = base_spans(text)
                every = [(*s, True) for s in base]
                every += [(*s, False) for s in added_spans(text, base, found)]
                every.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                spans[row] = [dict(zip(("kind", "start", "end", "base"), s)) for s in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, _FOUND)
