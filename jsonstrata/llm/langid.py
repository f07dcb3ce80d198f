"""Language identification of mixed-language text.

The script of a word narrows its candidate languages to those written in it. Every word has a score
for each candidate, the log-probability of its character trigrams, and a Viterbi pass with a penalty
for switching labels spans of one language. The language with most letters is the text's.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.arrays import spans
from jsonstrata.llm.frames import col, ready

#: First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS)
#: Trigrams are counted in this many hashed cells.
CELLS = 1 << 16
UNKNOWN = "und"
SPANS = "array<struct<start:int,end:int,lang:string>>"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: 1 for a letter, 2 for a mark that may belong to one; and its script."""
    letter = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(0x32400):
        letter[c] = {"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0)
    script = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            script[first : last + 1] = number
    return letter, script


@dataclass(frozen=True)
class Model:
    """Log-probabilities by (cell, language), and which languages are written in a script.

    Its size is bounded by the number of languages: 65,536 numbers each.
    """

    langs: list[str]
    scores: np.ndarray
    written: np.ndarray


class Words:
    """The words of several texts: runs of letters of one script, with the trigram cells of their letters."""

    def __init__(self, texts: list[str]):
        letter, script = _tables()
        # A text never shares a word with the next one: a line break stands between them.
        lowered = [t.lower() for t in texts]
        lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
        self.bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
        points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = letter[points]
        kinds = script[points]
        at = np.flatnonzero(inside)
        joined = np.zeros(len(at), bool)
        if len(at):
            joined[1:] = (at[1:] == at[:-1] + 1) & ((kinds[at[1:]] == kinds[at[:-1]]) | (inside[at[1:]] == 2))
            # Marks alone are no word.
            first = np.flatnonzero(~joined)
            real = np.add.reduceat(inside[at] == 1, first, dtype=np.int64) > 0
            real = np.repeat(real, np.diff(np.append(first, len(at))))
            at, joined = at[real], joined[real]
        before, after = at - 1, at + 1  # the last point is a line break
        left = np.where(joined, points[before], 0).astype(np.uint64)
        right = np.zeros(len(at), np.uint64)
        right[:-1] = np.where(joined[1:], points[after[:-1]], 0)
        mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (points[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= right * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        self.cells = (mixed >> np.uint64(48)).astype(np.int32)
        self.first = np.flatnonzero(~joined)  # number of a word's first letter
        self.letters = np.diff(np.append(self.first, len(at)))
        self.start = at[self.first]
        self.script = kinds[self.start]
        self.text = np.searchsorted(self.bounds, self.start, "right") - 1


def _ranges(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """The texts in ranges of a bounded size; a null text is an empty one."""
    texts = column.to_pylist()
    sizes = np.concatenate([[0], np.cumsum([len(t) if t else 0 for t in texts])])
    for i, j in spans(sizes, 1 << 20):
        yield i, j, [t or "" for t in texts[i:j]]


def train(
    labelled: DataFrame, rows_per_lang: int = 10_000, text_column: str = "text", lang_column: str = "lang"
) -> Model:
    """A model from labelled texts: at most about ``rows_per_lang`` of each language, chosen by a hash.

    Rows without a label or text teach nothing. The counts of trigrams are added up in Spark.
    """
    spark = labelled.sparkSession
    ready(spark)
    rows = labelled.select(col(lang_column).alias("lang"), col(text_column).alias("text")).dropna()
    share = {r["lang"]: min(1.0, rows_per_lang / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(share)
    number = {lang: i for i, lang in enumerate(langs)}
    if not langs:
        return Model([], np.zeros((CELLS, 0), np.float32), np.zeros((OTHER + 1, 0), bool))
    shares = spark.createDataFrame([(k, v) for k, v in share.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64("text", F.lit("draw")), F.lit(1 << 30)) / F.lit(1 << 30)
    rows = rows.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(langs), CELLS), np.int64)
        scripts = np.zeros((len(langs), OTHER + 1), np.int64)
        for batch in batches:
            owner = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for i, _, texts in _ranges(batch.column("text")):
                found = Words(texts)
                of = owner[i + found.text]
                np.add.at(scripts, (of, found.script), found.letters)
                np.add.at(cells, (np.repeat(of, found.letters), found.cells), 1)
        both = np.concatenate([cells, scripts], axis=1)
        lang, cell = np.nonzero(both)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(cell, pa.int32()), pa.array(both[lang, cell], pa.int64())],
            ["lang", "cell", "n"],
        )

    counted = rows.mapInArrow(count, "lang int, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    counts = counted.toArrow()
    both = np.zeros((len(langs), CELLS + OTHER + 1))
    both[counts.column("lang").to_numpy(), counts.column("cell").to_numpy()] = counts.column("n").to_numpy()
    cells, scripts = both[:, :CELLS], both[:, CELLS:]
    smooth = 0.1
    scores = np.log((cells + smooth) / (cells.sum(axis=1, keepdims=True) + smooth * CELLS))
    # A script with a thousandth of a language's letters is one that the language is written in.
    written = scripts > 0.001 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, np.ascontiguousarray(scores.T, np.float32), np.ascontiguousarray(written.T))


def _alone(score: np.ndarray, first: np.ndarray, counts: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """The best single language of each text, and whether no path with switches can beat it.

    A path that has the language somewhere pays at least a switch for every stretch in another one,
    so it can't win if no stretch gains a penalty. One that never has it starts and ends in others,
    with a switch in between for all stretches but one, so it can't win either if the best gains of
    a beginning and of an end together are below a penalty.
    """
    single = np.add.reduceat(score, first, axis=0, dtype=np.float64).argmax(axis=1)
    own = np.repeat(single, counts)
    most, begin, end = (np.full(len(first), -np.inf) for _ in range(3))
    last = first + counts - 1
    # Each text starts lower than any sum of the text before, so a running minimum starts anew.
    fall = np.repeat(np.arange(len(first)) * -1e9, counts)
    base = score[np.arange(len(score)), own].astype(np.float64)
    for lang in range(score.shape[1]):
        gain = score[:, lang] - base
        total = np.cumsum(gain)
        total -= np.repeat(total[first] - gain[first], counts)
        before = total - gain + fall
        stretch = total + fall - np.minimum.accumulate(before)
        most = np.maximum(most, np.maximum.reduceat(stretch, first))
        foreign = single != lang
        begin = np.where(foreign, np.maximum(begin, np.maximum.reduceat(total, first)), begin)
        tail = np.repeat(total[last], counts) - (total - gain)
        end = np.where(foreign, np.maximum(end, np.maximum.reduceat(tail, first)), end)
    return single, (most < switch - 0.1) & (begin + end < switch - 0.1)


def label_words(words: Words, model: Model, switch: float) -> np.ndarray:
    """The language number of every word, by a Viterbi pass over each text's words.

    Texts that are surely of one language need no pass. The other texts advance side by side, a word at a time, so that a step is one operation on an array.
    A word whose script no language is written in is free to follow its neighbours.
    """
    n, langs = len(words.first), len(model.langs)
    if not n or not langs:
        return np.zeros(n, np.int64)
    score = np.add.reduceat(model.scores[words.cells], words.first, axis=0)
    possible = model.written[words.script]
    known = possible.any(axis=1)
    score[known] = np.where(possible[known], score[known], score[known].min(axis=1, keepdims=True) - 10 * switch)
    score[~known] = 0
    counts = np.bincount(words.text, minlength=int(words.text.max()) + 1)
    first = np.cumsum(counts) - counts
    some = np.flatnonzero(counts)
    single, sure = _alone(score, first[some], counts[some], switch)
    label = np.repeat(single, counts[some])
    order = some[~sure]
    if not len(order):
        return label
    order = order[np.argsort(-counts[order], kind="stable")]
    lengths = counts[order]
    came = np.zeros((n, langs), np.int8 if langs < 128 else np.int32)
    best = score[first[order]].copy()
    own = np.arange(langs, dtype=came.dtype)
    active = len(order)
    steps = int(lengths[0])
    still = np.searchsorted(-lengths, -np.arange(1, steps + 1), "right")  # texts with at least so many words
    for step in range(1, steps):
        active = still[step]
        at = first[order[:active]] + step
        now = best[:active]
        top = now.argmax(axis=1)
        other = now[np.arange(active), top] - switch
        stay = now >= other[:, None]
        came[at] = np.where(stay, own, top[:, None].astype(came.dtype))
        best[:active] = np.where(stay, now, other[:, None]) + score[at]
        best[:active] -= best[:active].max(axis=1, keepdims=True)
    state = best.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        active = still[step]
        at = first[order[:active]] + step
        label[at] = state[:active]
        if step:
            state[:active] = came[at, state[:active]]
    return label


def _judge(texts: list[str], model: Model, switch: float) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words, the language number of each, and of each text the language number and its share of the letters.

    Letters of scripts that no language is written in are no language's.
    """
    words = Words(texts)
    label = label_words(words, model, switch)
    known = model.written[words.script].any(axis=1)
    share = np.zeros((len(texts), len(model.langs) + 1))
    np.add.at(share, (words.text[known], label[known]), words.letters[known])
    total = np.bincount(words.text, words.letters, len(texts))
    most = share.max(axis=1)
    # With letters of other scripts alone any language is as good: the first one, with score 0.
    none = np.where(total > 0, 0 if model.langs else len(model.langs), len(model.langs))
    best = np.where(most > 0, share.argmax(axis=1), none)
    score = np.divide(most, total, out=np.zeros(len(texts)), where=total > 0)
    label[most[words.text] == 0] = len(model.langs)
    return words, label, best, score


def reject(
    docs: DataFrame, model: Model, min_score: float = 0.5, switch: float = 12.0, text_column: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose text has a language with ``min_score`` of its letters.

    Null texts, texts without letters, and texts mostly in scripts that no language is written in go.
    The rest is as in :func:`identify`.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    number = docs.columns.index(text_column)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, texts in _ranges(batch.column(number)):
                _, _, best, score = _judge(texts, shared.value, switch)
                stays = (best < len(shared.value.langs)) & (score >= min_score)
                yield batch.slice(i, j - i).filter(pa.array(stays))

    return docs.mapInArrow(choose, docs.schema)


def identify(
    docs: DataFrame, model: Model, switch: float = 12.0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The language of every whole text: (doc_id, lang_pred, score, spans).

    ``score`` is the predicted language's share of the letters, from 0 to 1; those of scripts that no
    language is written in count as letters but not for the language, though a span may hold them. A
    span has code points of the lower-case text, its end exclusive. A text that is null or has no
    letter is ``und`` with score 0 and no span; so is every text if the model knows no language. A text
    of such scripts alone has one of the model's languages with score 0, and a span that is ``und``. Rows are read once and
    independent of each other, so repeated rows, very long texts and a source of any size need
    nothing special. Other columns aren't read and may have any name.
    """
    rows = docs.select(col(id_column).alias("doc_id"), col(text_column).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
        for batch in batches:
            for i, j, texts in _ranges(batch.column("text")):
                words, label, best, score = _judge(texts, model, switch)
                change = np.ones(len(label), bool)
                change[1:] = (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])
                head = np.flatnonzero(change) if model.langs else np.zeros(0, np.int64)
                tail = np.append(head[1:], len(label))[: len(head)] - 1
                of = words.text[head]
                offsets = np.searchsorted(of, np.arange(j - i + 1))
                start = words.start[head] - words.bounds[of]
                end = words.start[tail] + words.letters[tail] - words.bounds[of]
                flat = pa.StructArray.from_arrays(
                    [pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(names[label[head]], pa.string())],
                    fields=list(span),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        pa.array(names[best], pa.string()),
                        pa.array(score),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
                    ],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, spans {SPANS}")
