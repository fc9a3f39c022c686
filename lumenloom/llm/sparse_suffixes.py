"""Passages that repeat across documents, by a sparse suffix array.

Words are read as they stand. Of every window of ``PASSAGE`` words the k-gram with the smallest hash
is selected, so equal windows select the same place. Suffixes are kept at selected places only, and
of those only where the k-gram occurs again. Equal contexts are merged and counted; the rest is
sorted by what follows (then by what precedes) and each suffix is compared with its neighbours: the
words in common to the right and, extended, to the left tell which windows repeat. A neighbour has the
longest match to the right, not always to the left; where a window could still match a suffix that is
not a neighbour, its group's windows are compared by hash, so the result is exact.

No group of equal k-grams is held in one task: merging combines before the shuffle, and the sort deals
by content. A suffix at the edge of a task counts as one whose neighbour is unknown.

Contexts hold 32 bits a word, so two different words agree with a chance of 2**-32.

Defined results: null, empty and short texts have no repeated words. A passage repeated inside one
document counts, too. Repeated rows are copies of each other; rows that share an id but not the text, or
have none, are documents of their own. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenloom.llm import textvec as tv
from lumenloom.llm.tables import written

PASSAGE, GRAM = 50, 16
#: Ids of documents with repeated k-grams are sent to every task only up to this count (8 bytes each).
FEW_IDS = 1_000_000
LEFT = PASSAGE - GRAM  # a selected place lies at most so many words after the start of its window
_U = np.uint64


def selected(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``words``) and k-gram hashes of the leftmost smallest k-gram of every window."""
    grams = tv.gram_hashes(words, GRAM)
    if words.size < PASSAGE:
        return np.empty(0, np.int64), np.empty(0, _U)
    # the place in the low bits makes the leftmost win among equal k-grams
    low = (grams & _U(0xFFFFFFFF00000000)) | (np.arange(grams.size, dtype=_U) & _U(0xFFFFFFFF))
    span, least = 1, low
    while span < LEFT + 1:
        step = min(span, LEFT + 1 - span)
        least = np.minimum(least[: least.size - step], least[step:])
        span += step
    start = np.arange(least.size)
    inside = start + PASSAGE <= at[1:][tv.owners(at)[: least.size]]
    place = np.unique(least[inside] & _U(0xFFFFFFFF)).astype(np.int64)
    return place, grams[place]


_PLACE_SQL = "id long, doc_id long, place int, h long, n_words long"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Selected places of every text, and one row without a place that tells its number of words."""
    for batch in batches:
        for part in tv.slices(batch, "text", 4 << 20):
            words, at = tv.word_hashes(tv.texts_of(part.column("text")))
            place, h = selected(words, at)
            owner = np.searchsorted(at, place, side="right") - 1
            ids = np.asarray(part.column("doc_id").to_numpy(zero_copy_only=False), dtype=np.int64)
            none = len(ids)
            yield pa.RecordBatch.from_pydict({
                "id": pa.concat_arrays([part.column("id"), pa.nulls(place.size, pa.int64())]),
                "doc_id": pa.array(np.concatenate([ids, ids[owner]])),
                "place": pa.array(np.concatenate([np.zeros(none, np.int32), (place - at[owner]).astype(np.int32)]), mask=np.arange(none + place.size) < none),
                "h": pa.array(np.concatenate([np.zeros(none, np.int64), h.view(np.int64)])),
                "n_words": pa.array(np.concatenate([np.diff(at), np.zeros(place.size, np.int64)])),
            })


_SUFFIX = pa.schema([("doc_id", pa.int64()), ("place", pa.int32()), ("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("following", pa.binary()), ("preceding", pa.binary())])
_SUFFIX_SQL = "doc_id long, place int, h long, c1 long, c2 long, following binary, preceding binary"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of the kept places: words that follow, and words that precede, nearest first."""
    for batch in batches:
        for part in tv.slices(batch, "text", 1 << 20):
            words, at = tv.word_hashes(tv.texts_of(part.column("text")))
            lists = part.column("places").to_pylist()
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            place = np.array([p for x in lists for p in x], dtype=np.int64)
            fits = place + GRAM <= np.diff(at)[owner]
            owner, place = owner[fits], place[fits]
            if not place.size:
                continue
            short = (words >> _U(32)).astype(">u4")
            short[short == 0] = 1  # 0 stands for no word
            spot = at[owner] + place
            h = tv.gram_hashes(words, GRAM)[spot]

            def context(steps: np.ndarray) -> np.ndarray:
                where = spot[:, None] + steps
                inside = (where >= at[owner][:, None]) & (where < at[owner + 1][:, None])
                return np.where(inside, short[np.clip(where, 0, words.size - 1)], 0).astype(">u4")

            after, before = context(np.arange(PASSAGE)), context(-np.arange(1, LEFT + 1))
            both = np.concatenate([after, before], axis=1).astype(_U)
            c = [tv.mix((both * tv.salts(both.shape[1], s)).sum(axis=1)).view(np.int64) for s in (61, 62)]
            ids = part.column("doc_id").to_numpy()[owner]
            rows = [ids, place.astype(np.int32), h.view(np.int64), *c, [r.tobytes() for r in after], [r.tobytes() for r in before]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _SUFFIX)], schema=_SUFFIX)


def _bits(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers with bits low to high set; none if high is below low."""
    some = high >= low
    width = np.where(some, high - low + 1, 0)
    return np.where(some, ((np.int64(1) << width) - 1) << np.where(some, low, 0), 0)


def _common(a: np.ndarray) -> np.ndarray:
    """Leading words that each row shares with the next."""
    same = (a[:-1] == a[1:]) & (a[:-1] != 0)
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1)) if len(a) > 1 else np.empty(0, np.int64)


_FOUND = pa.schema([("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("mask", pa.int64()), ("open", pa.bool_()), ("edge", pa.bool_()), ("following", pa.binary()), ("preceding", pa.binary())])
_FOUND_SQL = "h long, c1 long, c2 long, mask long, open boolean, edge boolean, following binary, preceding binary"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u4").reshape(-1, width)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted contexts: bit o of the mask is set if the window that starts o words before repeats.

    ``open`` tells that a further window could match a suffix that is not a neighbour, ``edge`` that a
    neighbour is unknown, as the row is the first or last one of the task.
    """
    held, edge = None, True  # the last row so far waits for its next neighbour

    def judged(rows: pa.Table, known: int, last: bool) -> pa.RecordBatch:
        """Rows ``known`` to the end, without the last one unless nothing follows."""
        after, before = _matrix(rows.column("following"), PASSAGE), _matrix(rows.column("preceding"), LEFT)
        h, n = rows.column("h").to_numpy(), rows.num_rows
        right, left = _common(after), _common(before)
        right = np.where(h[1:] == h[:-1], right, 0)
        pair = np.where(right > 0, _bits(np.maximum(0, PASSAGE - right), np.minimum(left, LEFT)), 0)
        mask, reach, cut = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, dtype=bool)
        mask[1:] |= pair
        mask[:-1] |= pair
        reach[1:] = np.maximum(reach[1:], right)
        reach[:-1] = np.maximum(reach[:-1], right)
        if known == 0 and edge:
            reach[0], cut[0] = PASSAGE, True
        if last:
            reach[-1], cut[-1] = PASSAGE, True
        n_after, n_before = (after != 0).sum(axis=1), (before != 0).sum(axis=1)
        mask |= np.where(rows.column("n").to_numpy() > 1, _bits(np.maximum(0, PASSAGE - n_after), n_before), 0)
        could = _bits(np.maximum(0, PASSAGE - np.minimum(reach, n_after)), n_before)
        pick = np.arange(known, n if last else n - 1)
        useful = pa.array(np.where(could[pick] != 0, pick, 0), mask=could[pick] == 0)  # a null index gives a null context
        context = [rows.column(c).take(useful).combine_chunks() for c in ("following", "preceding")]
        out = [*(rows.column(c).take(pa.array(pick)).combine_chunks() for c in ("h", "c1", "c2")), pa.array(mask[pick]), pa.array((could & ~mask)[pick] != 0), pa.array(cut[pick]), *context]
        return pa.RecordBatch.from_arrays(out, schema=_FOUND)

    # two rows are carried: the one that waits, and the one before it, which it is compared with
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if rows.num_rows > 1:
            known = 0 if held is None or held.num_rows == 1 else 1
            yield judged(rows, known, False)
            edge = False
        held = rows.slice(max(0, rows.num_rows - 2))
    if held is not None:
        yield judged(held, held.num_rows - 1, True)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all windows of contexts, with the words that they start before the place."""
    f = [tv.salts(PASSAGE, s) for s in (71, 72)]
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            line = np.concatenate([_matrix(part.column("preceding"), LEFT)[:, ::-1], _matrix(part.column("following"), PASSAGE)], axis=1).astype(_U)
            for o in range(LEFT + 1):
                window = line[:, LEFT - o : LEFT - o + PASSAGE]
                full = np.flatnonzero((window != 0).all(axis=1))
                w = [tv.mix((window[full] * g).sum(axis=1)).view(np.int64) for g in f]
                pick = pa.array(full)
                yield pa.RecordBatch.from_pydict({"c1": part.column("c1").take(pick), "c2": part.column("c2").take(pick), "o": pa.array(np.full(full.size, o), pa.int32()), "w1": pa.array(w[0]), "w2": pa.array(w[1])})


def _covered(n: int, places: list[int], masks: list[int]) -> list[tuple[int, int]]:
    """Stretches of words, end exclusive, that lie in the windows of the masks."""
    starts = sorted({p - o for p, m in zip(places, masks) for o in range(LEFT + 1) if m >> o & 1})
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = s + PASSAGE
        else:
            out.append([s, s + PASSAGE])
    return [(a, b) for a, b in out if a >= 0 and b <= n]


_RESULT_SQL = "doc_id long, n_words long, n_repeated long, n_spans long, spans string"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, place, mask = (batch.column(c).to_pylist() for c in ("n_words", "places", "masks"))
        found = [_covered(k, p or [], m or []) for k, p, m in zip(n, place, mask)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("id"), "n_words": batch.column("n_words"),
            "n_repeated": pa.array([sum(b - a for a, b in f) for f in found], pa.int64()),
            "n_spans": pa.array([len(f) for f in found], pa.int64()),
            "spans": pa.array([",".join(f"{a}:{b}" for a, b in f) for f in found], pa.string()),
        })


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_repeated, n_spans and spans of every document.

    A word is repeated if it lies in a window of PASSAGE words that occurs at another place, in this or
    another document. ``spans`` lists stretches of repeated words as start:end word numbers.
    """
    number = F.col("doc_id").cast("long")
    # an id is a name only: rows are known by a hash of id and text
    docs = docs.select(number.alias("id"), F.xxhash64(number, "text").alias("doc_id"), "text")
    places = written(docs.mapInArrow(_places, _PLACE_SQL), "places")
    chosen = places.where("place IS NOT NULL").select("doc_id", "place", "h")
    again = chosen.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    # a table of its own, so that the join can split a k-gram that very many documents hold
    again = written(again, "again")
    kept = chosen.join(again, "h", "left_semi").groupBy("doc_id").agg(F.collect_set("place").alias("places"))
    kept = written(kept, "kept")
    ids = kept.select("doc_id")
    if kept.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    suffixes = written(texts.join(kept, "doc_id").mapInArrow(_suffixes, _SUFFIX_SQL), "suffixes")

    # equal contexts have equal windows: one row each, with their number
    contexts = suffixes.groupBy("h", "c1", "c2").agg(F.first("following").alias("following"), F.first("preceding").alias("preceding"), F.count("*").alias("n"))
    order = ["h", "following", "preceding"]
    found = written(contexts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, _FOUND_SQL), "found")

    # groups in which a window is still open, of three or more contexts or cut by the edge of a task: compare all their windows
    unsure = found.groupBy("h").agg(F.count("*").alias("n"), F.bool_or("open").alias("open"), F.bool_or("edge").alias("edge"))
    unsure = unsure.where("open AND (n > 2 OR (n = 2 AND edge))").select("h")
    left = found.where("following IS NOT NULL").join(unsure, "h", "left_semi").select("c1", "c2", "following", "preceding")
    # made twice rather than kept: they are many times the contexts
    windows = left.mapInArrow(_windows, "c1 long, c2 long, o int, w1 long, w2 long")
    twice = windows.groupBy("w1", "w2", "o").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2", "o")
    more = windows.join(twice, ["w1", "w2", "o"], "left_semi").groupBy("c1", "c2").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("more"))

    masks = found.join(more, ["c1", "c2"], "left").select("c1", "c2", F.col("mask").bitwiseOR(F.coalesce("more", F.lit(0))).alias("mask")).where("mask <> 0")
    masks = written(masks, "masks")  # as above, for a context that very many documents hold
    hits = suffixes.select("doc_id", "place", "c1", "c2").join(masks, ["c1", "c2"])
    hits = hits.groupBy("doc_id").agg(F.collect_list("place").alias("places"), F.collect_list("mask").alias("masks"))
    sizes = places.where("place IS NULL").select("id", "doc_id", "n_words")
    return sizes.join(hits, "doc_id", "left").mapInArrow(_spans, _RESULT_SQL)
