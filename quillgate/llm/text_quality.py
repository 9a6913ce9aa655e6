"""Problem 8: per-document text statistics, and running prose against everything else.

Every text gets word count, mean word length, symbol ratio, share of lines ending in punctuation, share of common words, and the share of its words that stand in
running prose. The common words of each language are learned from the corpus: words that stand in the running text of many documents of the language and seldom
in rows, lists and labels (document frequencies are kept in mergeable frequent-item summaries). For the last statistic a text is cut by its layout into units
(blocks of lines, list items and delimited rows apart), and each unit gets mean word length, symbol ratio, share of common words and an order score: the mean pointwise
mutual information of its neighbouring word classes, counted over the whole corpus per language. Mergeable quantile sketches (KLL) of every statistic per
language give percentiles and robust z-scores; a unit in a tail of any of them is no prose, and a document most of whose words stand in such units isn't either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import Scratch, clean

_WORD = re.compile(r"\w+")
_BULLET = re.compile(r"[-*+•‣◦–—·o]\s+|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)]\s+|\[[ xX]?\]\s|//+\s*|#+\s+|%+\s+")
_LABEL = re.compile(r"[\w-]+:\s")
_QUOTED = re.compile(r"^(?:[>|]\s*)+")
_SENTENCE = re.compile(r"[.!?][\"')»”]*\s+(\w)")
_CAPITAL = re.compile(r"\b[A-ZÀ-Þ][a-zß-ÿ]")
_END = tuple(".!?:;…。»”\"')")
_STOP = tuple(".!?…;:")
#: A unit of fewer than LEAST words is judged with its neighbour; a text of which a smaller share than TIED is common belongs to no language.
LEAST, TIED = 8, 0.06
#: Statistics of units: robust z-scores of the low and the high tail (None: no tail), and what a spread counts as at least.
TAILS = {"common": (-4.5, None, 0.08), "score": (-5.0, None, 0.25), "length": (-8.0, 8.0, 0.4), "symbols": (None, 12.0, 0.02)}
#: The share of words in prose below which a document isn't.
MOST = 0.5
#: A language is a stated code of that many documents with running text; its common words stand in COMMON_FROM of them or more and at most OUTSIDE times as
#: often in units that aren't running text. COMMON_WORDS is the most a language has.
LEAST_DOCS, COMMON_FROM, OUTSIDE, COMMON_WORDS = 20, 0.02, 0.3, 250
#: Words a frequent-item summary holds: a word in more than 1/HELD of the documents is never lost.
HELD = 100_000
#: Lines behind one marker are prose from so many words a line on; terse sentences have no more words than this on average.
LONG_LINES, TERSE = 7.6, 16

SUFFIXES, N_CLASS = 40, 40 + COMMON_WORDS


def suffix_class(w: str) -> int:
    """Class of a word that isn't common: names with digits or underscores 1, else by the last letter."""
    if not w.isalpha():
        return 1
    k = ord(w[-1])
    return 3 + k - 97 if 97 <= k <= 122 else 30


class Common:
    """Common words by language. A word's code is its number among all of them, or its suffix class; ``local`` turns codes into the classes of one language."""

    def __init__(self, words: dict[str, list[str]]):
        self.langs = tuple(sorted(words))
        every = sorted({w for ws in words.values() for w in ws})
        self.code = {w: SUFFIXES + k for k, w in enumerate(every)}
        self.n = SUFFIXES + len(every)
        self.bits = np.zeros((self.n, max(len(self.langs), 1)), np.int32)
        self.local = np.tile(np.concatenate((np.arange(SUFFIXES), [suffix_class(w) for w in every])).astype(np.uint16), (len(self.langs) + 1, 1))
        for k, name in enumerate(self.langs):
            for r, w in enumerate(words[name]):
                self.bits[self.code[w], k] = 1
                self.local[k, self.code[w]] = SUFFIXES + r
        self.german = self.langs.index("de") if "de" in self.langs else -1
        self.memo: dict[str, int] = {}

    def codes(self, ws: list[str]) -> list[int]:
        memo = self.memo
        if len(memo) > 500_000:
            memo.clear()
        try:
            return [memo[w] for w in ws]
        except KeyError:
            for w in ws:
                if w not in memo:
                    memo[w] = self.code[w] if w in self.code else suffix_class(w)
            return [memo[w] for w in ws]


class Summary:
    """Frequent items (Misra and Gries): counts of at most HELD words; when there are more, all lose what the least of them have."""

    def __init__(self):
        self.n: dict[tuple[str, str], list[int]] = {}

    def add(self, lang: str, words: set[str], side: int) -> None:
        n = self.n
        for w in words:
            if (lang, w) in n:
                n[lang, w][side] += 1
            else:
                n[lang, w] = [0, 0]
                n[lang, w][side] = 1
        if len(n) > 2 * HELD:
            least = sorted((max(v) for v in n.values()), reverse=True)[HELD]
            self.n = {k: [max(x - least, 0) for x in v] for k, v in n.items() if max(v) > least}


def stated(col):
    """The language a document states: a code of two or three letters, else null."""
    c = F.lower(clean(col))
    return F.when(c.rlike("^[a-z]{2,3}$") & (c != "und"), c)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequencies of words: in how many documents of a language in running text and outside; the word "" counts the documents."""
    seen = Summary()
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            sides: tuple[set[str], set[str]] = (set(), set())
            for prose, ws, _ in units(text)[0]:
                if ws and (not prose or len(ws) >= LEAST):
                    sides[0 if prose else 1].update(ws)
            for side, ws in enumerate(sides):
                if ws:
                    ws = {w for w in ws if w.isalpha()}
                    ws.add("")
                    if side or lang:
                        seen.add("" if side else lang, ws, side)
    keys = list(seen.n)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen.n[k][0] for k in keys], pa.int64()), pa.array([seen.n[k][1] for k in keys], pa.int64())], names=["lang", "word", "inside", "outside"])


def learn_common(documents: DataFrame) -> Common:
    """Common words per stated language, from all documents (lang, text). Without a lang column nothing is stated and there are none."""
    lang = stated(F.col("lang").cast("string")) if "lang" in documents.columns else F.lit(None).cast("string")
    w = documents.select(lang.alias("lang"), "text").mapInArrow(_words, "lang string, word string, inside long, outside long").groupBy("lang", "word").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    w = Scratch(documents.sparkSession).save(w)
    docs = w.where("word = '' and lang <> ''").select("lang", F.col("inside").alias("docs")).where(F.col("docs") >= LEAST_DOCS)
    layout = w.where("lang = ''").select("word", F.col("outside").alias("o"))
    others = (layout.where("word = ''").agg(F.max("o").alias("o")).first()["o"] or 0) + 1e-9
    x = w.where("lang <> '' and word <> ''").select("lang", "word", "inside").join(F.broadcast(docs), "lang").where(F.col("inside") >= COMMON_FROM * F.col("docs"))  # a row per language
    x = x.join(layout, "word", "left").where(F.coalesce(F.col("o"), F.lit(0)) / others <= OUTSIDE * F.col("inside") / F.col("docs"))
    top = x.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("inside"), "word"))).where(F.col("k") <= COMMON_WORDS)
    words: dict[str, list[str]] = {}
    for r in top.select("lang", "word", "k").orderBy("lang", "k").collect():  # COMMON_WORDS for each stated language
        words.setdefault(r["lang"], []).append(r["word"])
    return Common(words)


def units(text: str) -> tuple[list[tuple[bool, list[str], str]], int, int]:
    """Units of a text as (may be prose, words in lower case, wording), number of lines that aren't blank, number of those that end in punctuation.

    List items, delimited or labelled rows and blocks of short lines without an end are units that can't be prose; lines behind one marker that are long on
    average (a wrapped comment or quotation) can.
    """
    out: list[tuple[bool, list[str], str]] = []
    block: list[str] = []
    run: list[str] = []
    n_lines = n_end = short = 0
    marker = ""

    def close():
        nonlocal short
        if run:
            raw = " ".join(run)
            ws = _WORD.findall(raw.lower())
            out.append((len(ws) >= LONG_LINES * len(run), ws, raw))
            run.clear()
        if block:
            raw = " ".join(block)
            out.append((not (len(block) >= 3 and short >= 0.7 * len(block)), _WORD.findall(raw.lower()), raw))
            block.clear()
            short = 0

    for line in text.split("\n"):
        s = line.strip()
        if not s:
            close()
            continue
        n_lines += 1
        if s.endswith(_END):
            n_end += 1
        first = s[0]
        if (first == ">" or first == "|") and s[-1] != "|":
            s = s[_QUOTED.match(s).end() :].strip()
            if not s:
                close()
                continue
            first = s[0]
        blanks = s.count(" ")
        if not first.isalpha() or s[1:3].strip() in ("", ".", ")"):
            m = _BULLET.match(s)
            if m:
                mark = m.group().strip()
                if block or mark != marker:
                    close()
                marker = mark
                run.append(s[m.end() :])
                continue
        if run:
            close()
        gaps = s.count(",") - s.count(", ") + s.count(";") - s.count("; ") + s.count("\t") + s.count("  ") + s.count("|") - s.endswith((",", ";"))
        if gaps >= 2 and 6 * gaps >= blanks or blanks < 8 and ":" in s and _LABEL.match(s):
            close()
            out.append((False, _WORD.findall(s.lower()), ""))
            continue
        if blanks < 7 and not s.endswith(_STOP):
            short += 1
        block.append(s)
    close()
    return out, n_lines, n_end


def terse(raw: str, n_words: int, german: bool) -> bool:
    """Short sentences with few common words: ends come often, a capital follows them, and capitals stand nowhere else (German nouns apart)."""
    starts = _SENTENCE.findall(raw)
    if (len(starts) + 1) * TERSE < n_words or not raw.rstrip("\"')»”").endswith((".", "!", "?")):
        return False
    proper = sum(not c.islower() for c in starts)
    return proper >= 0.9 * len(starts) and (german or len(_CAPITAL.findall(raw)) <= 1.3 * (len(starts) + 1) + 1)


def measure(text: str, common: Common) -> dict:
    """All statistics of one text but the order scores. Per unit: words, common words, letters, symbols, and its standing: 0 can't be prose by its layout, 1 may be, 2 is terse prose."""
    parts, n_lines, n_end = units(text)
    seqs: list[list[int]] = []
    may: list[int] = []
    raws: list[str] = []
    letters: list[int] = []
    for prose, ws, raw in parts:
        if not ws:
            continue
        c = common.codes(ws)
        size = sum(map(len, ws))
        if seqs and may[-1] == prose and (len(c) < LEAST or len(seqs[-1]) < LEAST):
            seqs[-1] += c
            raws[-1] += " " + raw
            letters[-1] += size
        else:
            seqs.append(c)
            may.append(int(prose))
            raws.append(raw)
            letters.append(size)
    sizes = [len(c) for c in seqs]
    flat = np.fromiter((c for s in seqs for c in s), np.int32, sum(sizes))
    n = len(flat)
    lang, held = -1, np.zeros(len(sizes), np.int64)
    if n and common.langs:
        by_lang = np.bincount(flat, minlength=common.n) @ common.bits
        k = int(by_lang.argmax())
        lang = k if by_lang[k] >= TIED * n else -1
        held = np.add.reduceat(common.bits[flat, k], np.cumsum([0, *sizes[:-1]]))
        for i, m in enumerate(may):
            if m and terse(raws[i], sizes[i], k == common.german):
                may[i] = 2
    symbols = [max(len(r) - r.count(" ") - l, 0) if r else 0 for r, l in zip(raws, letters)]
    solid, total = len(text) - text.count(" ") - text.count("\n") - text.count("\t"), sum(letters)
    return {
        "lang": common.langs[lang] if lang >= 0 else "und",
        "n_words": n,
        "word_length": total / n if n else 0.0,
        "symbol_ratio": (solid - total) / solid if solid else 0.0,
        "end_share": n_end / n_lines if n_lines else 0.0,
        "common_share": int(held.sum()) / n if n else 0.0,
        "sizes": sizes,
        "may": may,
        "common": held.tolist(),
        "letters": letters,
        "symbols": symbols,
        "classes": common.local[lang][flat],
    }


def pairs(classes: np.ndarray, unit: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the class pairs at distance d inside a unit, and the unit of each."""
    same = unit[:-d] == unit[d:]
    return (classes[:-d].astype(np.int64) * N_CLASS + classes[d:])[same], unit[d:][same]


def information(counts: np.ndarray) -> np.ndarray:
    """Pointwise mutual information of class pairs, smoothed by a part of the expected count; counts: N_CLASS x N_CLASS."""
    n = max(float(counts.sum()), 1.0)
    expected = (counts.sum(1, keepdims=True) + 0.5) * (counts.sum(0, keepdims=True) + 0.5) / n
    extra = 0.05 * np.minimum(expected, 20) + 0.01
    return np.log((counts + extra) / (expected + extra)).astype(np.float32)


STATS = ("n_words", "word_length", "symbol_ratio", "end_share", "common_share")
_MEASURED = "doc_id long, lang string, n_words long, word_length double, symbol_ratio double, end_share double, common_share double, sizes array<int>, may array<int>, common array<int>, letters array<int>, symbols array<int>, classes binary"
_DOC = [("doc_id", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64())] + [(c, pa.float64()) for c in STATS[1:]] + [(c, pa.list_(pa.int32())) for c in ("sizes", "may", "common", "letters", "symbols")]


def _measure(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_DOC, ("classes", pa.binary())])
        common = shared.value
        for b in batches:
            rows = [measure(t, common) for t in b.column("text").to_pylist()]
            arrays = [b.column("doc_id")] + [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:-1]] + [pa.array([r["classes"].tobytes() for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _batch_units(b: pa.RecordBatch, langs: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, unit of each, language of each unit, sizes of the units of a batch."""
    classes = np.frombuffer(b"".join(b.column("classes").to_pylist()), np.uint16)
    sizes = b.column("sizes").flatten().to_numpy()
    per_doc = np.diff(b.column("sizes").offsets.to_numpy())
    code = {name: k for k, name in enumerate((*langs, "und"))}
    lang = np.repeat(np.array([code[x] for x in b.column("lang").to_pylist()], np.int64), per_doc)
    return classes, np.repeat(np.arange(len(sizes)), sizes), lang, sizes


def _count_pairs(langs: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            classes, unit, lang, _ = _batch_units(b, langs)
            for d in (1, 2):
                if len(unit) <= d:
                    continue
                code, u = pairs(classes, unit, d)
                of = lang[u]
                for k in np.unique(of).tolist():
                    n = np.bincount(code[of == k], minlength=N_CLASS**2)
                    acc[k, d] = acc[k, d] + n if (k, d) in acc else n
        for (k, d), n in acc.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(np.full(len(at), d)), pa.array(at), pa.array(n[at])], names=["lang", "d", "code", "n"])

    return run


#: A unit's statistics; symbols are a share of all signs.
_UNIT = {"common": "cast(u.common as double) / u.sizes", "score": "u.score", "length": "cast(u.letters as double) / u.sizes", "symbols": "cast(u.symbols as double) / (u.symbols + u.letters)"}


class Quality:
    """The statistics of one corpus; each pass is written once. documents: (doc_id, text, lang), lang may be missing; it only tells which words are learned together. Null ids, null texts and texts of blanks only are left out."""

    def __init__(self, documents: DataFrame):
        spark = documents.sparkSession
        scratch = Scratch(spark)
        docs = documents.where(r"doc_id is not null and text is not null and text rlike '\\S'")
        common = learn_common(docs)
        langs = common.langs
        measured = scratch.save(docs.select("doc_id", "text").mapInArrow(_measure(spark.sparkContext.broadcast(common)), _MEASURED))
        rows = measured.select("lang", "sizes", "classes").mapInArrow(_count_pairs(langs), "lang long, d long, code long, n long").groupBy("lang", "d", "code").agg(F.sum("n").alias("n"))
        counts = np.zeros((len(langs) + 1, 2, N_CLASS**2), np.float32)
        for r in rows.toPandas().itertuples():  # at most languages x 2 x classes squared rows, whatever the corpus
            counts[r.lang, r.d - 1, r.code] = r.n
        tables = np.stack([[information(c.reshape(N_CLASS, N_CLASS)).ravel() for c in lang] for lang in counts])
        shared = spark.sparkContext.broadcast(tables)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pmi = shared.value
            for b in batches:
                classes, unit, lang, sizes = _batch_units(b, langs)
                total = np.zeros(len(sizes))
                for d in (1, 2):
                    if len(unit) > d:
                        code, u = pairs(classes, unit, d)
                        total += np.bincount(u, pmi[lang[u], d - 1, code], len(sizes)) / np.maximum(sizes - d, 1)
                arrays = [b.column(n) for n, _ in _DOC] + [pa.ListArray.from_arrays(b.column("sizes").offsets, pa.array(total))]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([*_DOC, ("score", pa.list_(pa.float64()))]))

        self.scored = scratch.save(measured.mapInArrow(score, _MEASURED.replace("classes binary", "score array<double>")))
        scratch.drop(measured)
        self.spark = spark

    def sketches(self) -> DataFrame:
        """Per language a KLL sketch of each statistic; they merge, so languages, days or shards can be added up. Bounded in size."""
        return self.scored.groupBy("lang").agg(*[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(c) for c in STATS], F.count("*").alias("n_docs"))

    def unit_limits(self) -> DataFrame:
        """(lang, <statistic>_low, <statistic>_high): between what each of TAILS must lie in prose, from sketches of all units of LEAST + 4 words or more that may be prose."""
        u = self.scored.where("lang <> 'und'").select("lang", F.explode(F.arrays_zip("sizes", "may", "common", "letters", "symbols", "score")).alias("u")).where(f"u.may > 0 and u.sizes >= {LEAST + 4}")
        s = u.groupBy("lang").agg(*[F.kll_sketch_agg_double(F.expr(_UNIT[k])).alias(k) for k in TAILS])
        out = [F.col("lang")]
        for k, (low, high, floor) in TAILS.items():
            q = F.kll_sketch_get_quantile_double(k, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
            spread = lambda a, b: F.greatest(F.lit(floor), (q[b] - q[a]) / 0.6745)  # noqa: B023, E731
            out += [(q[1] + low * spread(1, 2) if low is not None else F.lit(None).cast("double")).alias(f"{k}_low"), (q[1] + high * spread(1, 2) if high is not None else F.lit(None).cast("double")).alias(f"{k}_high")]
        return s.select(*out)

    def prose(self) -> DataFrame:
        """scored with prose_share: the share of a document's words that stand in units of running prose. The limits are a row per language and broadcast."""
        j = self.scored.join(F.broadcast(self.unit_limits().withColumnRenamed("lang", "l")), F.col("lang") == F.col("l"), "left")
        inside = [f"coalesce({_UNIT[k]} >= {k}_low, l is not null)" for k, t in TAILS.items() if t[0] is not None and k != "score"] + [f"coalesce({_UNIT[k]} <= {k}_high, l is not null)" for k, t in TAILS.items() if t[1] is not None]
        fine = f"u.may = 2 or (u.may = 1 and {' and '.join(inside)} and (u.score >= score_low or u.sizes < 4))"
        words = F.expr(f"aggregate(arrays_zip(sizes, may, common, letters, symbols, score), 0, (a, u) -> a + if(coalesce({fine}, false), u.sizes, 0))")
        return j.withColumn("prose_share", F.when(F.col("n_words") > 0, words / F.col("n_words")).otherwise(F.lit(0.0))).select("doc_id", "lang", *STATS, "prose_share")

    def found(self) -> DataFrame:
        """(doc_id) of documents less than MOST of whose words are running prose; texts of symbols only are among them."""
        return self.prose().where(F.col("prose_share") < MOST).select("doc_id").distinct()

    def table(self) -> DataFrame:
        """One row per document: statistics, the percentile of each within its language and its robust z-score, the tails it lies in, and the verdict."""
        s = self.sketches()
        cols = [F.col("lang").alias("l")]
        for c in STATS:
            cols.append(F.kll_sketch_get_quantile_double(c, F.array(*[F.lit(k / 100) for k in range(1, 100)])).alias(f"{c}_q"))
        j = self.prose().join(F.broadcast(s.select(*cols)), F.col("lang") == F.col("l"))
        out = [F.col(c) for c in ("doc_id", "lang", *STATS, "prose_share")]
        tails = []
        for c in STATS:
            q = F.col(f"{c}_q")
            z = (F.col(c) - q[49]) / F.greatest(F.lit(1e-6), (q[74] - q[24]) / 1.349)
            out += [F.expr(f"size(filter({c}_q, x -> x <= {c}))").alias(f"{c}_pct"), z.alias(f"{c}_z")]
            tails.append(F.when(F.abs(z) > 3.5, F.concat(F.lit(c), F.when(z < 0, "-").otherwise("+"))))
        return j.select(*out, F.array_compact(F.array(*tails)).alias("tails"), (F.col("prose_share") >= MOST).alias("running_prose"))
