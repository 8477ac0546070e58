"""Personal data: seed entities, lexical patterns induced from them, and identifiers that confident patterns discover.

One pass over the texts finds the base entities (email, ip, card, phone) and every other string that looks like an identifier: a
token with '@', with four digits, or long and of letters and digits; groups of digits joined by blanks, dots, hyphens or
brackets are one string. Each comes with its lexical patterns: the word before it with the signs up to it, this with the value's
shape, the one and the two tokens before, and the token before with the one after. What follows works on these few rows only.

Seeds are the base entities of all texts and labelled values. Secrets have no form of their own, so their seeds are labelled
ones only: one text in `labelled` (by its checksum) is read by a labeller, which marks values behind a name for such (`token =
"..."`), and `seeds` may add more. In all other texts a secret is found through patterns or not at all.

Patterns and instances (distinct values, lower case) form a bipartite graph that Spark scores in rounds, to a fixed point. The
confidence of a pattern for a base kind is the sum of its instances' scores over their number (plus `smoothing`); for secrets, of
which unlabelled texts say nothing, only instances in labelled texts and those that are sure count. An instance's score is that
of its best pattern, and seeds keep 1. A pattern needs `min_seeds` distinct instances of at least `min_score` to count in a
round, so values discovered in one round induce patterns in the next; what is sure stays sure. Instances that end at `min_score`
or more are added as spans of that kind, and so is every further place of a seed's value; base spans stay.

Base matching follows the patterns literally (leftmost, non-overlapping per kind, failing matches dropped without
retries) but walks from anchors, so a long run of one class costs linear time. Offsets are code points, ends exclusive.

Defined results: null or empty text has no spans and the digest of the empty string; texts and tokens of any length are read
whole (patterns over 64 characters count by digest); repeated rows are reported each, yet a value counts once in the graph; a
value that scores alike for two kinds gets the first of them as listed; other columns, whatever their names, are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, forget, small_batches, splittable

BASE = ("email", "ip", "card", "phone")
#: Base kinds and those that only the method finds.
KINDS = (*BASE, "secret")
SECRET = len(BASE)
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LIKELY = re.compile(r"[0-9@]")
#: What the labeller of secrets marks, in labelled texts only.
_SECRET = re.compile(r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?[ ]{0,2}[:=]{1,2}[ ]{0,2}[\"']?([A-Za-z0-9+/_.-]{8,}+)")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_GROUPS = re.compile(r"(?<![0-9])[+(]?[0-9]++(?:[ .()-]{1,2}[0-9]++)+")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W_]+")
_LETTER = re.compile(r"[A-Za-z]")
_EDGE = "\"'()[]{}<>,;:!?.*#$%&|="
_LONG, _PATTERN = 12, 64
#: One text in so many is labelled.
LABELLED = 4
FOUND = "row long, doc_id long, labelled boolean, n_email long, n_ip long, n_card long, n_phone long, base array<struct<start:int,kind:int,end:int>>, marks array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>"
_FOUND = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("labelled", pa.bool_()), *((f"n_{k}", pa.int64()) for k in BASE),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("marks", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))),
])


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, last := m.end()))
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    small = lambda part: len(p := part.lstrip("0")) < 3 or len(p) == 3 and p <= "255"
    return [m.span() for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order of start, then kind."""
    if not _LIKELY.search(text):
        return []
    return sorted((a, k, b) for k, find in enumerate((emails, ips, cards, phones)) for a, b in find(text))


def _bounded(pattern: str) -> str:
    return pattern if len(pattern) <= _PATTERN else pattern[:2] + hashlib.md5(pattern.encode()).hexdigest()


def _side(text: str, at: int, step: int) -> list[str]:
    """Up to two whole tokens before (step -1) or one after (step 1) a place, however long they are."""
    n, want = 64, 2 if step < 0 else 1
    while True:
        piece = text[max(0, at - n) : at] if step < 0 else text[at : at + n]
        tokens = _TOKEN.findall(piece)
        if len(tokens) > want or len(piece) < n:
            return tokens[-2:] if step < 0 else tokens[:1]
        n *= 8


def shape(value: str) -> str:
    """Runs of digits and letters by class and length class, other signs as they are."""
    out = []
    for m in re.finditer(r"[0-9]+|[^\W\d_]+|.", value):
        run = m[0]
        out.append(f"{'9' if run[0].isdigit() else 'a'}{len(run).bit_length()}" if run[0].isalnum() else run)
    return "".join(out) if len(out) <= 8 else f"*{len(value).bit_length()}"


def _brief(text: str, a: int, b: int) -> str:
    """text[a:b], or where that is long how long it is and its end: constant work for any mark."""
    return text[a:b] if b - a <= _PATTERN else f"~{(b - a).bit_length()}{text[b - 8 : b]}"


def word_bounds(text: str) -> tuple[list[int], list[int]]:
    """Where runs of letters and digits begin and end."""
    found = [m.span() for m in _WORD.finditer(text)]
    return [a for a, _ in found], [b for _, b in found]


def patterns(text: str, a: int, b: int, words: tuple[list[int], list[int]] | None = None) -> list[str]:
    """Lexical patterns of text[a:b], lower case; signs that part it by far from the word before it count by how far, and their last ones."""
    left = [t.strip(_EDGE).lower() or t for t in _side(text, a, -1)]
    after = [t.strip(_EDGE).lower() or t for t in _side(text, b, 1)]
    out = []
    starts, ends = words if words else word_bounds(text)
    i = bisect.bisect_left(starts, a) - 1  # the last word that begins before the value, and its part before it
    if i >= 0:
        end = min(ends[i], a)
        sign = (_brief(text, starts[i], end) + _brief(text, end, a)).lower()
        out += [f"p:{sign}", f"s:{sign}{shape(text[a:b])}"]
    if left:
        out.append(f"1:{left[-1]}")
    if len(left) == 2:
        out.append(f"2:{left[0]} {left[1]}")
    if left and after:
        out.append(f"a:{left[-1]} _ {after[0]}")
    return [_bounded(x) for x in out]


def _loose(text: str) -> Iterator[tuple[int, int]]:
    """Strings that look like identifiers: digit groups first, then tokens."""
    for m in _GROUPS.finditer(text):
        if 7 <= len(_DIGITS.findall(m[0])) <= 19:
            yield m.span()
    for m in _TOKEN.finditer(text):
        token = m[0]
        if not _LIKELY.search(token) or not ("@" in token or len(_DIGITS.findall(token)) >= 4 or len(token) >= _LONG and _LETTER.search(token)):
            continue
        a = m.start() + len(token) - len(token.lstrip(_EDGE))
        b = m.end() - len(token) + len(token.rstrip(_EDGE))
        if a < b:
            yield a, b


def labelled_text(text: str, share: int = LABELLED) -> bool:
    return zlib.crc32(text.encode()) % share == 0


def marks(text: str, base: list[tuple[int, int, int]], labelled: bool) -> list[dict]:
    """Base entities, in a labelled text named secrets, and other strings that look like identifiers, with their patterns. Later ones do not overlap earlier ones."""
    if not _LIKELY.search(text):
        return []
    taken = sorted((a, b) for a, _, b in base)
    found = [(a, b, k) for a, k, b in base]
    for spans in ([(*m.span(1), SECRET) for m in _SECRET.finditer(text)] if labelled else [], [(a, b, None) for a, b in _loose(text)]):
        starts, new = [a for a, _ in taken], []
        reach = list(accumulate((b for _, b in taken), max))
        for a, b, kind in spans:
            i = bisect.bisect_left(starts, b)
            if not i or reach[i - 1] <= a:
                new.append((a, b, kind))
        new.sort(key=lambda x: x[:2])
        kept: list[tuple] = []
        for x in new:
            if not kept or kept[-1][1] <= x[0]:
                kept.append(x)
            elif x[1] - x[0] > kept[-1][1] - kept[-1][0]:
                kept[-1] = x  # the longer of two that overlap
        found += kept
        taken = sorted(taken + [x[:2] for x in kept])
    words = word_bounds(text) if found else None
    return [{"start": a, "end": b, "kind": k, "value": text[a:b].lower(), "patterns": patterns(text, a, b, words)} for a, b, k in found]


def _scanner(labelled: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                base = base_spans(text := text.as_py() or "")
                counts = {f"n_{name}": sum(k == i for _, k, _ in base) for i, name in enumerate(BASE)}
                sure = bool(labelled) and labelled_text(text, labelled)
                out.append({"row": row, "doc_id": doc_id, "labelled": sure, **counts, "base": [{"start": a, "kind": k, "end": b} for a, k, b in base], "marks": marks(text, base, sure)})
                row += 1
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return scan


def induce(found: DataFrame, rounds: int | None = None, min_seeds: int = 5, min_score: float = 0.9, smoothing: float = 0.25, seeds: DataFrame | None = None) -> DataFrame:
    """(value, kind) of seeds and of what confident patterns discover in found(labelled, marks), after `rounds` or at the fixed point."""
    marked = found.select("labelled", F.explode("marks").alias("m")).select("labelled", "m.*")
    known = marked.where("kind is not null").select("value", "kind")
    sown = cut((known if seeds is None else known.unionByName(seeds.select(F.lower("value").alias("value"), F.col("kind").cast("int").alias("kind")))).distinct())
    edges = cut(marked.select("value", "labelled", F.explode("patterns").alias("pattern")).groupBy("value", "pattern").agg(F.max("labelled").alias("labelled")))
    # an instance or a pattern that meets no seed in any number of rounds needs no score; those that do stay few
    total = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if("labelled").alias("n_labelled"))
    score, done, before = sown.withColumn("score", F.lit(1.0)), 0, -1
    while rounds is None or done < rounds:
        is_sure = F.col("score") >= min_score
        counts = F.col("labelled") | is_sure
        sums = [F.sum("score").alias("sum"), F.count_if(is_sure).alias("sure"), F.sum(F.when(counts, F.col("score")).otherwise(0.0)).alias("own"), F.count_if(is_sure & ~F.col("labelled")).alias("more")]
        met = splittable(edges, score.hint("merge"), ["value"]).groupBy("pattern", "kind").agg(*sums).where(F.col("sure") >= min_seeds)
        confidence = F.when(F.col("kind") == SECRET, F.col("own") / (F.col("n_labelled") + F.col("more") + smoothing)).otherwise(F.col("sum") / (F.col("n") + smoothing))
        confident = met.join(total.hint("merge"), "pattern").select("pattern", "kind", F.round(confidence, 9).alias("score"))  # sums of doubles in any order are equal
        lifted = splittable(edges, confident.hint("merge"), ["pattern"]).select("value", "kind", "score")
        last, score = score, cut(lifted.unionByName(sown.withColumn("score", F.lit(1.0))).groupBy("value", "kind").agg(F.max("score").alias("score")))
        if hasattr(last, "_cut"):
            forget(last)
        sure = score.where(F.col("score") >= min_score).count()
        done += 1
        if sure == before:
            break
        before = sure
    forget(edges, sown)
    return score.where(F.col("score") >= min_score).groupBy("value").agg(F.min_by("kind", F.struct(-F.col("score"), "kind")).alias("kind"))


def _joined(spans):
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(documents: DataFrame, rounds: int | None = None, min_seeds: int = 5, min_score: float = 0.9, labelled: int = LABELLED, seeds: DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans of every row of documents(doc_id, text).

    One text in `labelled` is labelled (0: none); seeds(value, kind), kind a place in KINDS, are further labelled values."""
    small_batches(documents.sparkSession)
    found = cut(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scanner(labelled), FOUND))
    new = induce(found, rounds, min_seeds, min_score, seeds=seeds)
    loose = found.select("row", F.explode("marks").alias("m")).where(f"m.kind is null or m.kind = {SECRET}").select("row", "m.start", "m.end", "m.value")
    more = splittable(loose, new.hint("merge"), ["value"]).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    counts = [f"n_{k}" for k in BASE]
    out = found.select("row", "doc_id", *counts, "base").join(more.hint("merge"), "row", "left")
    added = F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    spans = F.concat("base", added)
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(spans).alias("spans"), F.size(added).cast("long").alias("n_added"), F.size(spans).cast("long").alias("n_spans"))


def digest(spans: list[tuple[int, int, int]]) -> str:
    """What base_sha256 holds for spans of one text."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
