"""Substring de-duplication by sliding sentence spans.

Every run of consecutive sentences is hashed, and so is a sentence alone if it has enough words. A
long sentence is also divided where its words say so, at the same places in every copy, and runs of
such parts are hashed. Equal runs of all documents meet, and what lies in any run but the first of its
kind is removed.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from jsonstrata.llm.arrays import BASES, LOWER, SPACE, U64, buffers, mix, powers, spans, stretches, words
from jsonstrata.llm.frames import keep
from jsonstrata.llm.removal import COVERED, KEYED, SCHEMA, as_table, by_bucket, cut, groups, id_bucket, packed, texts, unpacked

#: Bytes of text whose runs are sorted together before they are sent.
TOGETHER = 16 << 20
#: Of so many consecutive words of a long sentence the one with the least hash begins a part.
PART_WORDS = 5
#: Bytes that end a sentence before white space, and the one that always does.
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".!?"]] = True
LINE = ord("\n")


def _parts(value: np.ndarray, sentence: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Runs of parts of sentences: two hashes, and the first word and the one after the last.

    A run has ``least`` words, and more up to the end of a part; it lies within one sentence. Two
    copies of some words are divided alike but for the ``PART_WORDS - 1`` words at each end.
    """
    n = len(value)
    starts = np.append(True, sentence[1:] != sentence[:-1])
    begins = starts.copy()
    if n >= PART_WORDS:
        windows = np.lib.stride_tricks.sliding_window_view(value, PART_WORDS)
        at = np.arange(len(windows)) + windows.argmin(axis=1)
        begins[at[sentence[: len(windows)] == sentence[PART_WORDS - 1 :]]] = True
    begin = np.flatnonzero(begins)
    ends = np.append(np.flatnonzero(starts)[1:], n)
    begin_end = ends[np.cumsum(starts)[begin] - 1]
    edges = np.append(begin, n)
    head = begin[begin + least <= begin_end]
    tail = edges[np.searchsorted(edges, head + least)]
    hashes = []
    for base in BASES:
        up, down = powers(base, n + 1)
        sums = np.zeros(n + 1, U64)
        np.cumsum(mix(value ^ U64(base)) * up[:n], out=sums[1:])
        hashes.append(mix((sums[tail] - sums[head]) * down[head] ^ (tail - head).astype(U64)))
    return *hashes, head, tail


def sentence_runs(data: np.ndarray, bounds: np.ndarray, k: int, min_words: int, alone_words: int) -> tuple[np.ndarray, ...]:
    """Every run of sentences: two hashes, text number, first byte, and number of bytes.

    A run has ``k`` sentences, and more until it has ``min_words`` words, or is one sentence of at
    least ``alone_words`` words. Sentences of more than twice as many words have runs of their parts
    besides. White space and the case of A to Z don't count.
    """
    none = np.zeros(0, np.int64)
    start, end, owner = words(data, bounds, ~SPACE)
    if not len(start):
        return none.astype(U64), none.astype(U64), none, none, none
    value = stretches(LOWER[data], start, end)
    blank = SPACE[data]
    stop = STOPS[data]
    stop[:-1] &= blank[1:]
    stop |= data == LINE
    stop[bounds[bounds > 0] - 1] = True
    part = np.cumsum(stop) - stop
    of = part[start]
    first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (owner[1:] != owner[:-1])))
    count = np.diff(np.append(first, len(of)))
    place = np.arange(len(of)) - np.repeat(first, count)
    up, _ = powers(BASES[1], int(place.max()) + 2)
    sentence = mix(np.add.reduceat(value * up[place + 1], first) ^ count.astype(U64))
    text = owner[first]
    # The run from each sentence: long enough in sentences and in words, and within its text.
    total = np.concatenate([[0], np.cumsum(count)])
    last = np.searchsorted(total, total[:-1] + min_words, "left") - 1
    last = np.maximum(last, np.arange(len(first)) + k - 1)
    fits = last < len(first)
    fits[fits] = text[last[fits]] == text[fits]
    head, alone = np.flatnonzero(fits), np.flatnonzero(count >= alone_words)
    head, tail = np.concatenate([head, alone]), np.concatenate([last[head], alone])
    hashes = []
    for base in BASES:
        up, down = powers(base, len(first) + 1)
        sums = np.zeros(len(first) + 1, U64)
        np.cumsum(mix(sentence ^ U64(base)) * up[: len(first)], out=sums[1:])
        hashes.append(mix((sums[tail + 1] - sums[head]) * down[head] ^ (tail - head).astype(U64)))
    # A removed sentence takes the white space after it along.
    begin = start[first]
    stops = np.append(begin[1:], len(data))
    stops = np.minimum(stops, bounds[text + 1])
    found = [(hashes[0], hashes[1], text[head], begin[head], stops[tail] - begin[head])]
    long = np.repeat(count > 2 * alone_words, count)
    if long.any():
        at = np.flatnonzero(long)
        key, check, head, tail = _parts(value[at], np.repeat(np.arange(len(first)), count)[at], alone_words)
        head, tail = at[head], at[tail - 1] + 1
        stops = np.minimum(np.append(start, len(data))[tail], bounds[owner[head] + 1])
        found.append((key, check, owner[head], start[head], stops - start[head]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _later(key, check, ids, start):
    """Order of the rows, and which of them come after the first of their key."""
    order = np.lexsort((start, ids, check, key))
    first = groups(key[order], check[order])
    later = (ids[order] != ids[order][first]) | (start[order] != start[order][first])
    return order, later


def _joined(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same bytes of each text in stretches that don't touch: the runs from every part overlap."""
    if not len(ids):
        return ids, start, size
    order = np.lexsort((start, ids))
    ids, start, size = ids[order], start[order].astype(np.int64), size[order].astype(np.int64)
    new = np.append(True, ids[1:] != ids[:-1])
    beside = np.cumsum(new) << 32  # places of different texts lie apart
    end = np.maximum.accumulate(beside + start + size)
    new[1:] |= (beside + start)[1:] > end[:-1]
    first = np.flatnonzero(new)
    return ids[first], start[first], np.append(end[first[1:] - 1], end[-1]) - (beside + start)[first]


def drop_repeated_sentences(
    docs: DataFrame,
    run_sentences: int = 2,
    min_words: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    alone_words: int = 10,
) -> DataFrame:
    """Texts without repeated sentence spans: (doc_id, n_bytes, spans, kept).

    A sentence is removed when it lies in a run of ``run_sentences`` consecutive sentences, longer
    where these have less than ``min_words`` words, that stands in a document of a smaller id or
    earlier in its own, or when it stands there alone and has ``alone_words`` words. A sentence of
    more than twice as many words is also divided at words of a locally least hash, and runs of its
    parts of ``alone_words`` words or more are treated like sentences. Sentences end at ``.``, ``!``
    or ``?`` before white space and at line breaks; white space and the case of A to Z don't count.
    ``spans`` are removed runs of UTF-8 bytes, the end exclusive, and ``kept`` is the rest.

    Runs are judged on the input, so a chain of removals can't start from removed text. Null and
    empty texts, and texts without a run, stay. Rows without an id stay and take no part. A repeated row is treated like the first. Ids are whole numbers and name one text.
    Empty tables give no rows; other columns may have any name.
    """
    rows, buckets = texts(docs, id_column, text_column)

    def hash_runs(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, done = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            _, bounds = buffers(batch.column("text"))
            for i, j in spans(bounds):
                data, inner = buffers(batch.column("text").slice(i, j - i))
                key, check, text, start, size = sentence_runs(data, inner, run_sentences, min_words, alone_words)
                held.append((key, (check >> U64(32)), ids[i + text], start - inner[text], size))
                done += len(data)
                if done >= TOGETHER:
                    yield from send(held)
                    held, done = [], 0
        if held:
            yield from send(held)

    def send(held: list) -> Iterable[pa.RecordBatch]:
        key, check, of, start, size = (np.concatenate(x) for x in zip(*held, strict=True))
        order, later = _later(key, check, of, start)
        late, early = order[later], np.sort(order[~later])
        gone = _joined(of[late], start[late], size[late])
        yield from packed(COVERED, id_bucket(gone[0], buckets), *gone)
        bucket = (key[early] % U64(buckets)).astype(np.int64)
        yield from packed(KEYED, bucket, of[early], start[early], size[early], key[early], check[early])

    def meet(table: pa.Table) -> pa.Table:
        x = unpacked(table, KEYED)
        order, later = _later(x["key"], x["check"], x["ids"], x["start"])
        late = order[later]
        gone = _joined(x["ids"][late], x["start"][late], x["size"][late])
        through = table.filter(pa.compute.equal(table.column("kind"), COVERED))
        return pa.concat_tables([through, as_table(packed(COVERED, id_bucket(gone[0], buckets), *gone))])

    hashed = rows.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(hash_runs, SCHEMA)
    covered = keep(by_bucket(hashed, buckets).groupBy("bucket").applyInArrow(meet, SCHEMA))
    return cut(rows, covered, buckets)
