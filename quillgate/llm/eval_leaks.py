"""Problem 6: evaluation texts leaking into training text, by latent semantic retrieval.

Passages are windows of WIN words. Terms are words and pairs of neighbouring words; their weights are TF-IDF with document frequencies counted over all
documents. A randomised SVD of the evaluation passages (products per partition, summed by term over the cluster) gives RANK latent directions. Every passage of
every document that can hold a leak is projected and searched by cosine against all evaluation passages. A hit is settled by a local alignment of the two word
sequences: SPAN words of the item's own wording or more, at most one in CHANGED changed.

Which passages can hold a leak is a count, not a threshold: of SPAN - 1 neighbouring pairs of an item's words, a change breaks two at most, and of two windows
that overlap by half one holds all but a few of the rest, so a window with fewer than PAIRS pairs that stand in an item holds no leak (``tests/llm`` tries all
offsets). Items are searched in blocks of BLOCK_WORDS own words, which bounds the terms, all that is broadcast and what the driver sums, whatever the items' number
and length; the corpus is tokenised once for all blocks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Scratch

WIN, STEP, ITEM_STEP = 24, 12, 6
RANK, SPARE, SEED = 128, 16, 11
COSINE = 0.72
SPAN, CHANGED = 20, 8
#: Pairs of neighbouring item words that some window over a leak holds at least.
PAIRS = 10
#: An opening sentence that so many different items share is task wording.
SHARED_OPENING = 3
#: Own words of the items searched at once: at most twice as many terms, 46 MB of latent directions.
BLOCK_WORDS = 40_000
#: Terms of one row of the summed sketch.
CHUNK = 2048

_WORD = re.compile(r"\w+")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,60}>")
_LINE_NUMBER = re.compile(r"^[ \t]*\d+[:.)\]|][ \t]+", re.M)
_OPENING = r"^(\s*[^.!?]*[.!?])\s"


def words(text: str) -> list[str]:
    """Words in lower case; markup, punctuation, line prefixes and layout don't count."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    return _WORD.findall(_LINE_NUMBER.sub("", text).lower())


def own_wording(items: DataFrame) -> DataFrame:
    """(item_id, text) without the opening sentence if SHARED_OPENING different texts or more begin with it. Null ids and texts are left out."""
    x = items.select("item_id", "text", F.regexp_extract("text", _OPENING, 1).alias("opening")).where("item_id is not null and text is not null")
    common = x.where("opening <> ''").groupBy("opening").agg(F.countDistinct("text").alias("n")).where(F.col("n") >= SHARED_OPENING).select("opening", "n")
    return x.join(common, "opening", "left").select("item_id", F.when(F.col("n").isNotNull(), F.expr("substr(text, length(opening) + 1)")).otherwise(F.col("text")).alias("text"))


_memo: dict[str, int] = {}


def codes(text: str) -> np.ndarray:
    """The words of a text as 64-bit hashes; underscores around a word are markup."""
    ws = words(text)
    if len(_memo) > 500_000:
        _memo.clear()
    for w in ws:
        if w not in _memo:
            _memo[w] = xxhash.xxh3_64_intdigest(w.strip("_") or w)
    return np.fromiter((_memo[w] for w in ws), np.uint64, len(ws))


class Lexicon:
    """The words and terms of a block of items. Term numbers: words first, from 1, then pairs; everything else is foreign (word 0)."""

    def __init__(self, texts: list[np.ndarray]):
        self.known = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint64)
        self.width = len(self.known) + 1
        ids = [self.ids(t) for t in texts]
        self.pairs = np.unique(np.concatenate([i[:-1].astype(np.int64) * self.width + i[1:] for i in ids])) if ids else np.zeros(0, np.int64)
        self.n = self.width + len(self.pairs)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_lookup"}  # made again where it is needed

    @property
    def lookup(self) -> np.ndarray | None:
        if "_lookup" not in self.__dict__:
            self._lookup = None
            if self.width**2 <= 1 << 24:
                self._lookup = np.full(self.width**2, -1, np.int32)
                self._lookup[self.pairs] = np.arange(self.width, self.n)
        return self._lookup

    def ids(self, coded: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(coded), np.int32)
        at = np.minimum(np.searchsorted(self.known, coded), len(self.known) - 1)
        return np.where(self.known[at] == coded, at + 1, 0).astype(np.int32)

    def pair_terms(self, ids: np.ndarray) -> np.ndarray:
        """Term of (word, next word) at every position, -1 where it is foreign. The last position has none."""
        out = np.full(len(ids), -1, np.int64)
        if len(ids) > 1 and len(self.pairs):
            code = ids[:-1].astype(np.int64) * self.width + ids[1:]
            if self.lookup is not None:
                hit = self.lookup[code]
            else:
                at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
                hit = np.where(self.pairs[at] == code, at + self.width, -1)
            out[:-1] = np.where((ids[:-1] > 0) & (ids[1:] > 0), hit, -1)
        return out


def passages(ids: np.ndarray, step: int = ITEM_STEP) -> list[slice]:
    last = max(len(ids) - WIN, 0)
    return [slice(s, s + WIN) for s in [*range(0, last, step), last]]


def term_rows(lex: Lexicon, idf: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(terms, unit weights) of an item's passages."""
    pt, out = lex.pair_terms(ids), []
    for s in passages(ids):
        one = ids[s]
        t, n = np.unique(np.concatenate((one[one > 0], pt[s][:-1][pt[s][:-1] >= 0])), return_counts=True)
        w = n * idf[t]
        norm = np.sqrt((w * w).sum())
        if norm > 0:
            out.append((t, (w / norm).astype(np.float32)))
    return out


def _product(rows: list[tuple[np.ndarray, np.ndarray]], right: np.ndarray) -> np.ndarray:
    return np.array([w @ right[t] for t, w in rows], np.float32).reshape(len(rows), right.shape[1])


def randomised_svd(spark, items: list[tuple[int, np.ndarray]], lex: Lexicon, idf: np.ndarray) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passage matrix A: Z = A'(A Omega), then (A V)'(A V) for an orthonormal basis V of Z.

    Products are made per partition of the items; the sketch is cut into CHUNK terms and summed chunk by chunk over the cluster, so the driver gets it once.
    """
    parts = 4
    shared = spark.sparkContext.broadcast((lex, idf))
    frame = spark.createDataFrame([(i, ids.tobytes()) for i, ids in items], "item_id long, ids binary").repartition(parts)
    size = RANK + SPARE

    def rows_of(b: pa.RecordBatch, lx: Lexicon, weight: np.ndarray):
        return [r for x in b.column("ids") for r in term_rows(lx, weight, np.frombuffer(x.as_py(), np.int32))]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lx, weight = shared.value
        omega = np.random.default_rng(SEED).standard_normal((lx.n, size), np.float32)
        z, touched = np.zeros((lx.n, size), np.float32), np.zeros(lx.n, bool)
        for b in batches:
            rows = rows_of(b, lx, weight)
            for (t, w), r in zip(rows, _product(rows, omega)):
                z[t] += w[:, None] * r
                touched[t] = True
        for a in range(0, lx.n, CHUNK):
            if touched[a : a + CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int64()), pa.array([z[a : a + CHUNK].tobytes()], pa.binary())], names=["a", "z"])

    def add(pdf):
        return pdf.iloc[:1].assign(z=[sum(np.frombuffer(x, np.float32) for x in pdf["z"]).tobytes()])

    z = np.zeros((lex.n, size), np.float32)
    for r in frame.mapInArrow(sketch, "a long, z binary").groupBy("a").applyInPandas(add, "a long, z binary").toLocalIterator():  # a group has a row per partition
        z[r["a"] : r["a"] + CHUNK] = np.frombuffer(r["z"], np.float32).reshape(-1, size)
    v, _ = np.linalg.qr(z)
    basis = spark.sparkContext.broadcast(np.ascontiguousarray(v, np.float32))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lx, weight = shared.value
        for b in batches:
            y = _product(rows_of(b, lx, weight), basis.value)
            yield pa.RecordBatch.from_arrays([pa.array([(y.T @ y).astype(np.float32).tobytes()], pa.binary())], names=["m"])

    small = sum(np.frombuffer(r["m"], np.float32) for r in frame.mapInArrow(gram, "m binary").collect()).reshape(v.shape[1], v.shape[1])
    _, u = np.linalg.eigh(small.astype(np.float64))
    basis.unpersist()
    shared.unpersist()
    return (v @ u[:, ::-1][:, : min(RANK, u.shape[1])]).astype(np.float32)


def alignment(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment of word ids (0 matches nothing): (own words, changes) of its longest stretch with at most one change in CHANGED words of b."""
    js = np.arange(len(b) + 1, dtype=np.int32)
    h = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    score = np.where((a[:, None] == b[None, :]) & (b[None, :] > 0), 1, -1)
    for i in range(1, len(a) + 1):
        t = np.maximum(h[i - 1] - 1, 0)
        t[1:] = np.maximum(t[1:], h[i - 1, :-1] + score[i - 1])
        h[i] = np.maximum.accumulate(t + js) - js
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    own, bad = [], []
    while i > 0 and j > 0 and h[i, j] > 0:
        if h[i, j] == h[i - 1, j - 1] + score[i - 1, j - 1]:
            own.append(1)
            bad.append(int(score[i - 1, j - 1] < 0))
            i, j = i - 1, j - 1
        elif h[i, j] == h[i, j - 1] - 1:
            own.append(1)
            bad.append(1)
            j -= 1
        else:
            own.append(0)
            bad.append(1)
            i -= 1
    po, pb = np.concatenate(([0], np.cumsum(own))), np.concatenate(([0], np.cumsum(bad)))
    length, errors = po[None, :] - po[:, None], pb[None, :] - pb[:, None]
    length = np.where(errors * CHANGED <= length, length, 0)
    k = int(length.argmax())
    return int(length.flat[k]), int(errors.flat[k])


class Searcher:
    """What a worker needs of a block: lexicon, weighted directions, latent item passages, item words."""

    def __init__(self, lex: Lexicon, idf: np.ndarray, basis: np.ndarray, items: list[tuple[int, np.ndarray]]):
        self.lex, self.items = lex, dict(items)
        self.direct = np.concatenate((basis * idf[:, None], np.zeros((1, basis.shape[1])))).astype(np.float32)
        latent, owner = [], []
        for i, ids in items:
            rows = term_rows(lex, idf, ids)
            latent.append(_product(rows, basis))
            owner += [i] * len(rows)
        latent = np.concatenate(latent)
        norm = np.linalg.norm(latent, axis=1)
        keep = norm > 1e-6
        self.latent, self.owner = (latent[keep] / norm[keep, None]).astype(np.float32), np.array(owner)[keep]

    def candidates(self, docs: list[np.ndarray]) -> list[tuple[int, int, float, int]]:
        """(document, item, cosine, first word of the passage) of all passages that hold PAIRS pairs of item words and whose latent cosine is COSINE or more."""
        out = []
        sizes = np.array([len(d) for d in docs], np.int64)
        blocks = -(-sizes // STEP)
        start = np.concatenate(([0], np.cumsum(blocks * STEP)[:-1]))
        n = int((blocks * STEP).sum())
        one, two = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for k, d in enumerate(docs):
            s = slice(start[k], start[k] + len(d))
            one[s] = np.where(d > 0, d, -1)
            two[s] = self.lex.pair_terms(d)
        one, two = one.reshape(-1, STEP), two.reshape(-1, STEP)
        doc = np.repeat(np.arange(len(docs)), blocks)
        joined = np.concatenate((doc[1:] == doc[:-1], [False]))  # a window is a step and the next one of its document
        pairs = (two >= 0).sum(1)
        held = pairs + np.where(joined, np.concatenate((pairs[1:], [0])), 0)
        windows = np.flatnonzero(held >= PAIRS)
        steps = np.unique(np.concatenate((windows, windows[joined[windows]] + 1)))
        vec = np.zeros((len(steps), self.direct.shape[1]), np.float32)
        for a in range(0, len(steps), 1024):
            part = steps[a : a + 1024]
            got = self.direct[one[part]].sum(1)
            terms = two[part].ravel()
            live = np.flatnonzero(terms >= 0)
            if len(live):
                edges = np.flatnonzero(np.concatenate(([True], np.diff(live // STEP) > 0)))
                got[live[edges] // STEP] += np.add.reduceat(self.direct[terms[live]], edges, axis=0)
            vec[a : a + len(part)] = got
        at = np.searchsorted(steps, windows)
        win = vec[at]
        two_steps = joined[windows]
        win[two_steps] += vec[at[two_steps] + 1]
        length = np.linalg.norm(win, axis=1)
        live = np.flatnonzero(length > 0)
        first = windows * STEP - start[doc[windows]]
        for a in range(0, len(live), 1024):
            part = live[a : a + 1024]
            c = (win[part] / length[part, None]) @ self.latent.T
            r, k = np.nonzero(c >= COSINE)
            out += zip(doc[windows[part[r]]].tolist(), self.owner[k].tolist(), c[r, k].tolist(), first[part[r]].tolist())
        return out

    def leaks(self, docs: list[np.ndarray]) -> list[tuple[int, int, int, int, float]]:
        """(document, item, own words, changes, cosine) of all leaks."""
        spots: dict[tuple[int, int], list] = {}
        for d, i, c, at in self.candidates(docs):
            s = spots.setdefault((d, i), [0.0, []])
            s[0] = max(s[0], c)
            s[1].append(at)
        out = []
        for (d, i), (c, ats) in spots.items():
            item, doc = self.items[i], docs[d]
            reach, best, ats = len(item) + STEP, (0, 0), sorted(set(ats))
            lo, hi = ats[0] - reach, ats[0] + WIN + reach
            for at in [*ats[1:], None]:
                if at is not None and at - reach <= hi:
                    hi = at + WIN + reach
                    continue
                best = max(best, alignment(doc[max(lo, 0) : hi], item), key=lambda x: x[0])
                if at is not None:
                    lo, hi = at - reach, at + WIN + reach
            if best[0] >= SPAN:
                out.append((d, i, *best, c))
        return out


_CODED = pa.schema([("doc_id", pa.int64()), ("words", pa.binary())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()), ("n_changed", pa.int32()), ("cosine", pa.float64())])


def _search_block(coded: DataFrame, n_docs: int, block: list[tuple[int, np.ndarray]]) -> DataFrame:
    spark = coded.sparkSession
    lex = Lexicon([w for _, w in block])
    items = [(i, lex.ids(w)) for i, w in block]
    shared = spark.sparkContext.broadcast(lex)

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lx = shared.value
        df = np.zeros(lx.n, np.int64)
        for b in batches:
            for x in b.column("words"):
                ids = lx.ids(np.frombuffer(x.as_py(), np.uint64))
                pt = lx.pair_terms(ids)
                df[np.unique(ids)] += 1
                df[np.unique(pt[pt >= 0])] += 1
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(df[t])], names=["term", "n"])

    df = np.zeros(lex.n)
    seen = coded.select("words").mapInArrow(count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # at most the block's terms
    df[seen["term"].to_numpy()] = seen["n"].to_numpy()
    idf = np.log((n_docs + 1) / (df + 1)).astype(np.float32)
    idf[0] = 0
    model = spark.sparkContext.broadcast(Searcher(lex, idf, randomised_svd(spark, items, lex, idf), items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            texts = [m.lex.ids(np.frombuffer(x.as_py(), np.uint64)) for x in b.column("words")]
            a = 0
            while a < len(texts):  # pieces of about 200,000 words
                z, held = a, 0
                while z < len(texts) and (z == a or held + len(texts[z]) <= 200_000):
                    held += len(texts[z])
                    z += 1
                keep = [k for k in range(a, z) if len(texts[k])]
                if keep:
                    got = m.leaks([texts[k] for k in keep])
                    if got:
                        d, i, n, e, c = zip(*got)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[[keep[k] for k in d]]), pa.array(i, pa.int64()), pa.array(n, pa.int32()), pa.array(e, pa.int32()), pa.array(c, pa.float64())], schema=_FOUND)
                a = z

    return coded.mapInArrow(search, "doc_id long, item_id long, n_words int, n_changed int, cosine double")


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([codes(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())], schema=_CODED)


def eval_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_words, n_changed, cosine): every leak of an item's own wording into a document; distinct.

    Null ids and texts, and texts without words, hold nothing. Items of fewer than SPAN own words can't leak. Copies of a document are found each. Documents of
    any length are searched whole; a document costs memory in proportion to its own length only. An item longer than BLOCK_WORDS is a block of its own. Other
    columns of the inputs are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text").where("doc_id is not null and text is not null and text <> ''")
    coded, seen = Scratch(spark).counted(docs.mapInArrow(_code, "doc_id long, words binary"))
    found = None
    block: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        nonlocal found, block, held
        if block:
            got = _search_block(coded, seen["n"], block)
            found = got if found is None else found.union(got)
            block, held = [], 0

    for r in own_wording(items).orderBy("item_id").toLocalIterator():
        w = codes(r["text"])
        if len(w) < SPAN:
            continue
        if held + len(w) > BLOCK_WORDS:
            flush()
        block.append((r["item_id"], w))
        held += len(w)
    flush()
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, n_words int, n_changed int, cosine double")
    return found.distinct()


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per item that leaked: number of documents, the longest passage, and the sources' number."""
    leaks = eval_leaks(documents, items)
    src = documents.select("doc_id", F.lower(F.trim("source")).alias("source"))
    return leaks.join(src, "doc_id", "left").groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("n_words").alias("longest"), F.countDistinct("source").alias("n_sources"))
