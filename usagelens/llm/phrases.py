"""Phrase collocations by Rabin-Karp fingerprints.

Texts are dealt into pages of one language (``pages``). In a page, prefix
polynomials over its words' bytes give each word's fingerprint, and polynomials over
these the fingerprint of every n-gram. A page posts each fingerprint once, with its
number of occurrences; an occurrence pointer is the page and the fingerprint's place
in it. A shuffle by ranges of fingerprints sums them and tells each page which of its
fingerprints are frequent (``frequent_fingerprints``). Only those become text:
a page follows its pointers, splits occurrences whose words differ, and the counts
of equal phrases are summed by their text (``frequent_phrases``), so a collision of
fingerprints can bring a phrase to this step but never change its count.

``collocations`` scores the frequent phrases by their worst cut and drops those that
a longer phrase explains; ``top`` ranks them within their language.

Defined cases: null is the empty text; a null language is ``und``; texts without a
word give nothing; a piece longer than a page stays whole in a page of its own;
repeated rows count each time; equal scores are ordered by count, then by the
phrase's bytes; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm import base

MIN_COUNT = 10
MAX_WORDS = 3
EXPLAINED = 50  # percent of a phrase's occurrences that a longer one must hold to replace it
TOP = 2000
SCALE = 1_000_000

PAGE_BYTES = 4 << 20  # of text in a page
HELD_PAGES = 4  # pages a task may hold while it fills them
BUCKET_BYTES = 32 << 20  # of fingerprints that meet in a task
SALTS = 64  # parts a language's candidates are ranked in first

ENDS = b".,;:!?\n\x0b\x0c\r"
NORMAL = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(ENDS) + b" ")

PAGES = "page long, lang string, n_words long, data binary"
PHRASES = "lang string, phrase string, n_words int, a long"
MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)


# --- Pages ------------------------------------------------------------------------


def pages(docs: DataFrame, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """Lower-cased texts of one language end to end, pieces apart by line ends, words by spaces."""
    types = base.arrow_schema(StructType.fromDDL(PAGES))

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        count = 0

        def page(lang: str) -> pa.RecordBatch:
            nonlocal count
            data = b"\n".join(held.pop(lang))
            del sizes[lang]
            count += 1
            return base.record_batch([[base.page_number(count)], [lang], [len(data.split())], [data]], types)

        for batch in batches:
            langs = ["und" if x is None else x for x in batch.column("lang").to_pylist()]
            for lang, text in zip(langs, base.text_bytes(batch), strict=True):
                for part in parts(text.translate(NORMAL), page_bytes):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                    if sizes[lang] >= page_bytes:
                        yield page(lang)
                    elif sum(sizes.values()) > HELD_PAGES * page_bytes:
                        yield page(max(sizes, key=sizes.get))
        for lang in list(held):
            yield page(lang)

    return base.saved(docs.select("lang", "text").mapInArrow(run, StructType.fromDDL(PAGES)), "phrase_pages", compression="zstd")


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about size bytes, cut between pieces only."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(b"\n", start + 1, start + size)
        cut = text.find(b"\n", start + size) if cut < 0 else cut
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


# --- Fingerprints -----------------------------------------------------------------


class Grams:
    """The n-grams of a page: words as numbers of its dictionary, and fingerprints of all n-grams."""

    def __init__(self, data: bytes, max_words: int, bits: int = 64):
        raw = np.frombuffer(data, np.uint8)
        inside = (raw != 32) & (raw != 10)
        starts, ends = base.spans_of(inside)
        self.max_words, self.size, self.bits = max_words, len(starts), np.uint64(64 - bits)
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside].tobytes())])
        coded = words.dictionary_encode()
        self.words = np.array(coded.indices)
        self.texts = coded.dictionary.to_pylist()
        lengths = np.array([len(x) for x in self.texts], np.int64)
        ends = np.cumsum(lengths)
        self.prints = base.Rolling(np.frombuffer(b"".join(self.texts), np.uint8))(ends - lengths, ends)[self.words]
        self.piece = np.cumsum(raw == 10, dtype=np.int32)[starts]

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the n-grams that lie in a piece, and their fingerprints."""
        if self.size < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[n - 1 :] == self.piece[: self.size - n + 1])
        total = np.full(len(at), n, np.uint64)
        for i in range(n):
            total = total * MULTIPLIER + self.prints[at + i]
        return at, base.mix(total) >> self.bits

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of words, first word and fingerprint of every n-gram."""
        found = [self.of(n) for n in range(1, self.max_words + 1)]
        n = np.repeat(np.arange(1, self.max_words + 1, dtype=np.int32), [len(at) for at, _ in found])
        return n, *(np.concatenate(x) for x in zip(*found, strict=True))


def salted(prints: np.ndarray, lang: str) -> np.ndarray:
    """Fingerprints of phrases of one language: the same phrase has another in another language."""
    seed = base.Rolling(np.frombuffer(lang.encode() + b"\0", np.uint8))(np.array([0]), np.array([len(lang.encode()) + 1]))
    return base.mix(prints ^ seed)


def frequent_fingerprints(paged: DataFrame, min_count: int, max_words: int, bits: int = 64) -> DataFrame:
    """For each page, a byte for each of its fingerprints in order: 1 if the corpus may hold it min_count times.

    Sums come from truncated fingerprints and are never too low.
    """
    spark = paged.sparkSession
    words = paged.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    width = np.dtype("u1" if min_count < 256 else "<u4")
    n = max(base.parts(spark), words * max_words * (4 + width.itemsize) // BUCKET_BYTES + 1)

    def make():
        def act(batch):
            rows = []
            for page, lang, data in zip(*(batch.column(c).to_pylist() for c in ("page", "lang", "data")), strict=True):
                keys, counts = np.unique(salted(Grams(data, max_words, bits).all()[2], lang), return_counts=True)
                rows += base.ask(page, keys, np.minimum(counts, min_count).astype(width), n, width=4)
            return list(zip(*rows, strict=True)) if rows else None

        return act

    def reply(group: np.ndarray, first: np.ndarray, more: bytes) -> np.ndarray:
        total = np.add.reduceat(np.frombuffer(more, width).astype(np.int64), first)
        return (total >= min_count).astype(np.uint8)[group]

    asked = base.map_batches(paged.select("page", "lang", "data"), make, base.ASKED)
    return base.answers(asked, reply, "<u4", "frequent")


def frequent_phrases(paged: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, bits: int = 64) -> DataFrame:
    """Phrases of up to max_words words that a language's texts hold min_count times, with that number."""
    told = frequent_fingerprints(paged, min_count, max_words, bits)

    def make():
        def act(batch):
            out = [[], [], [], []]
            for lang, data, said in zip(*(batch.column(c).to_pylist() for c in ("lang", "data", "answers")), strict=True):
                grams = Grams(data, max_words, bits)
                n, at, prints = grams.all()
                _, place = np.unique(salted(prints, lang), return_inverse=True)
                kept = np.flatnonzero(base.answer_bytes(said)[place])
                n, at = n[kept], at[kept]
                if not len(kept):
                    continue
                order = np.argsort(place[kept], kind="stable")
                n, at, place = n[order], at[order], place[kept][order]
                # Occurrences of one fingerprint may be other phrases: a row ends where their words differ.
                words = [np.where(n > i, grams.words[np.minimum(at + i, grams.size - 1)] + 1, 0) for i in range(max_words)]
                change = np.append(True, place[1:] != place[:-1])
                for w in words:
                    change[1:] |= w[1:] != w[:-1]
                head = np.flatnonzero(change)
                texts = [b"", *grams.texts]
                out[0] += [lang] * len(head)
                out[1] += [b" ".join([texts[w] for w in row if w]).decode() for row in zip(*(w[head].tolist() for w in words), strict=True)]
                out[2] += n[head].tolist()
                out[3] += np.diff(np.append(head, len(n))).tolist()
            return out

        return act

    joined = paged.select("page", "lang", "data").join(told, "page").drop("page")
    found = base.map_batches(joined, make, PHRASES)
    total = found.groupBy("lang", "phrase", "n_words").agg(F.sum("a").alias("a"))
    return base.saved(total.filter(F.col("a") >= min_count), "phrases")


# --- Scores -----------------------------------------------------------------------


def part(first: int, n: int) -> Column:
    """n words of the phrase from number first (from 0) on."""
    return F.array_join(F.slice(F.split("phrase", " "), first + 1, n), " ")


def collocations(phrases: DataFrame, max_words: int = MAX_WORDS, explained: int = EXPLAINED) -> DataFrame:
    """Phrases of two or more words with their worst cut (l, r, score), without those that a longer one explains.

    Parts of a frequent phrase are frequent, so all counts are found among phrases.
    Numbers are multiplied as decimals of 38 digits.
    """
    wide = lambda x: F.col(x).cast("decimal(15,0)")
    scored = None
    for n in range(2, max_words + 1):
        own = phrases.filter(F.col("n_words") == n)
        # Each cut of a phrase asks for two counts.
        cuts = own.select("lang", "phrase", "a", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), part(0, k).alias("left"), part(k, n - k).alias("right")) for k in range(1, n)])).alias("cut"))
        cuts = cuts.select("lang", "phrase", "a", "cut.*")
        for side, count in (("left", "l"), ("right", "r")):
            cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
        exact = cuts.withColumns({"square": F.lit(SCALE).cast("decimal(7,0)") * (wide("a") * wide("a")), "product": wide("l") * wide("r")})
        cuts = exact.withColumn("score", F.expr("square div product")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        cuts = cuts.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        scored = cuts if scored is None else scored.unionByName(cuts)
    if scored is None:
        raise ValueError("a collocation has two words at least")
    inner = [part(i, k) for n in range(3, max_words + 1) for k in range(2, n) for i in range(n - k + 1)]
    sizes = [(n, i, k) for n in range(3, max_words + 1) for k in range(2, n) for i in range(n - k + 1)]
    if not inner:
        return scored
    inside = F.array_compact(F.array(*[F.when(F.col("n_words") == n, x) for (n, _, _), x in zip(sizes, inner, strict=True)]))
    longer = phrases.filter("n_words > 2").select("lang", F.col("a").alias("longest"), F.explode(inside).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    joined = scored.join(longer, ["lang", "phrase"], "left")
    return joined.filter(F.col("longest").isNull() | (100 * F.col("longest") < explained * F.col("a"))).drop("longest")


def top(scored: DataFrame, n: int = TOP) -> DataFrame:
    """Each language's first n by score, count and phrase; parts of a language are ranked first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted_ = scored.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    first = salted_.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= n)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= n).drop("salt")


def judge(docs: DataFrame, n: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, page_bytes: int = PAGE_BYTES, bits: int = 64) -> DataFrame:
    """Each language's best phrases; bits (of a fingerprint) is lowered only to test collisions."""
    paged = pages(docs, page_bytes)
    totals = paged.groupBy("lang").agg(F.sum("n_words").alias("n"))
    best = top(collocations(frequent_phrases(paged, min_count, max_words, bits), max_words), n)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words
    FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), places AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
    SELECT lang, n, words[i:i + n - 1] AS gram FROM places, (SELECT unnest(range(1, {MAX_WORDS} + 1)) AS n) WHERE i + n - 1 <= len(words)
), counts AS (
    SELECT lang, n, gram, array_to_string(gram, ' ') AS phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
), cuts AS (
    SELECT lang, gram, phrase, a, unnest(range(1, n)) AS k, n AS size FROM counts WHERE n > 1
), scored AS (
    SELECT c.lang, c.gram, c.phrase, c.a, c.k, x.a AS l, y.a AS r, CAST((CAST({SCALE} AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.gram = c.gram[1:c.k] JOIN counts y ON y.lang = c.lang AND y.gram = c.gram[c.k + 1:c.size]
), worst AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), inner_grams AS (
    SELECT lang, a, n, gram, unnest(range(1, n + 1)) AS i FROM counts WHERE n > 2
), inside AS (
    SELECT lang, gram[i:i + k - 1] AS gram, max(a) AS longest
    FROM inner_grams, (SELECT unnest(range(2, {MAX_WORDS})) AS k) WHERE k < n AND i + k - 1 <= n GROUP BY ALL
), kept AS (
    SELECT w.* FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.gram = w.gram WHERE i.longest IS NULL OR 100 * i.longest < {EXPLAINED} * w.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.phrase) AS rank, k.phrase, k.a, k.l, k.r, t.n, k.score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= {TOP}
"""
