"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: a slot holds a bitmask of
languages, and the AND of an n-gram's slots is the set of all languages that
contain it.  Per text and language the set bits are counted and corrected
for the language's false-positive rate; the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import byte_class, core, fit_in_task, slices, utf8_view

LETTER = byte_class((0x00, 0x60), (0x7B, 0x7F))   # a-z and the bytes of non-ASCII characters
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SAMPLE = 1000                  # learning documents of each language, expected number
ENOUGH = 20                    # documents of a language from which an n-gram must occur in two of them
SLOTS_A_GRAM = 16
RARE = 0.1                     # an n-gram belongs to a language if at least so frequent against where it is most frequent
UNKNOWN = "und"


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-byte n-grams (uint32) of lower-cased letters, and the text each is from.

    Whatever is no letter counts as a space; a space may be only an n-gram's
    first or last byte, so n-grams see word borders but not two words.
    """
    if len(data) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    letter = LETTER[data]
    b = np.where(letter, data, 32).astype(np.uint32)
    code = (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    ok = letter[1:-2] & letter[2:-1] & (doc[3:] == doc[:-3])
    return code[ok], doc[:-3][ok]


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class Filters:
    """Slots of language bitmasks (one plane for each 8 languages), and each language's false-positive rate."""

    languages: list[str]
    planes: list[np.ndarray]
    shift: int
    false_rate: np.ndarray

    def slots(self, code: np.ndarray) -> list[np.ndarray]:
        x = code.astype(np.uint64)
        return [(x * np.uint64(h) >> np.uint64(self.shift)).astype(np.int64) for h in HASHES]

    def counts(self, code: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """(texts, languages) corrected counts of the languages' n-grams."""
        total = np.bincount(doc, minlength=n)
        at = self.slots(code)
        out = np.zeros((n, len(self.languages)))
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        for k, plane in enumerate(self.planes):
            mask = plane[at[0]]
            for a in at[1:]:
                mask = mask & plane[a]
            seen = np.bincount(doc * 256 + mask, minlength=n * 256).reshape(n, 256) @ bits
            own = min(8, len(self.languages) - 8 * k)
            out[:, 8 * k:8 * k + own] = seen[:, :own]
        f = self.false_rate[None, :]
        return np.maximum(0.0, (out - total[:, None] * f) / (1 - f))


def train(texts: list[str], langs: list[str]) -> Filters:
    """Fill the filter from labelled texts."""
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    chosen, tables = [], []
    for name in names:
        own = pa.array([t for t, x in zip(texts, langs) if x == name], pa.string())
        codes = []
        for part, _, _ in slices(iter([pa.RecordBatch.from_arrays([own], ["text"])])):
            code, doc = grams(*utf8_view(pc.utf8_lower(part.column(0))))
            codes.append((np.unique((code.astype(np.uint64) << np.uint64(24)) | doc.astype(np.uint64)) >> np.uint64(24)).astype(np.uint32))
        g, c = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.uint32), return_counts=True)
        tables.append((g, c / max(1, len(own)), c >= (2 if len(own) >= ENOUGH else 1)))
    every = np.unique(np.concatenate([t[0] for t in tables])) if tables else np.zeros(0, np.uint32)
    most = np.zeros(len(every))
    for g, share, _ in tables:
        at = np.searchsorted(every, g)
        most[at] = np.maximum(most[at], share)
    for g, share, supported in tables:
        chosen.append(g[(share >= RARE * most[np.searchsorted(every, g)]) & supported])
    largest = max([len(g) for g in chosen], default=1)
    width = max(10, int(np.ceil(np.log2(max(2, largest * SLOTS_A_GRAM)))))
    planes = [np.zeros(1 << width, np.uint8) for _ in range(-(-len(names) // 8))]
    out = Filters(names, planes, 64 - width, np.zeros(len(names)))
    for name, g in zip(names, chosen):
        k = number[name]
        for at in out.slots(g):
            planes[k // 8][at] |= np.uint8(1 << k % 8)
        fill = (planes[k // 8] >> np.uint8(k % 8) & 1).mean()
        out.false_rate[k] = min(0.99, fill ** len(HASHES))
    return out


def fit(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> Filters:
    """Fill the filter from about ``sample`` documents of each language, picked by the id's hash."""
    allowed = F.lit(True) if learn is None else learn
    known = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    share = {r["lang"]: min(1.0, sample / r["n"]) for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        return train([], [])
    shares = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = known.where(draw < shares[F.col("lang")])
    return fit_in_task(rows, lambda r: train([x[1] for x in r], [x[2] for x in r]))


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred and score (the winner's share of all corrected counts).

    A null text or one without a letter is ``und`` with score 0.  Ties go to
    the first language in code-point order, as do texts with no known
    n-gram (score 0).  Without any learned language every text is ``und``.
    Repeated rows are each predicted; other columns are ignored; an empty
    table gives no rows.
    """
    src = core(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for part, _, _ in slices(batches, text_col):
            data, off = utf8_view(pc.utf8_lower(part.column(text_col)))
            n = part.num_rows
            ascii_letters = np.add.reduceat(np.append((data >= 97) & (data <= 122), False), np.minimum(off[:-1], len(data))) * (np.diff(off) > 0)
            lettered = ascii_letters > 0
            for i in np.flatnonzero(~lettered):
                lettered[i] = has_letter(part.column(text_col)[int(i)].as_py())
            if model.languages:
                c = model.counts(*grams(data, off), n)
                best, total = c.argmax(axis=1), c.sum(axis=1)
                p = np.where(lettered & (total > 0), c[np.arange(n), best] / np.maximum(total, 1e-12), 0.0)
                lang = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
            else:
                p, lang = np.zeros(n), [UNKNOWN] * n
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(lang, pa.string()), pa.array(np.clip(p, 0, 1))],
                                             [id_col, "lang_pred", "score"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
