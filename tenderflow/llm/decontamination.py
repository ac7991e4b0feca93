"""Operator 6: benchmark decontamination by rare n-gram seeds and local alignment.

1. Seeds: every run of ``n`` words of a benchmark item. A seed that at most ``RARE_ITEMS`` items hold is rare and joins
   the documents that hold it to those items. Rarity is judged within the benchmark, so a copy that stands all over the
   corpus is found like one that stands there once.
2. Common seeds ("which of the following") are not dropped. A region around such a seed can reach ``threshold`` only if
   it holds one of the item's guard words: of its m words in order of rarity the first m - need + 1, where need words are
   the fewest that reach the threshold (of need shared words one must be among them). So a common seed joins through
   the pair (seed, guard word in its window): exact, and it does not meet every item that shares the seed. An item
   with more than ``PAIR_KEYS`` such pairs is joined by its common seeds themselves.
3. Seeds of one item that lie close together in a document open a region of it around where the item would lie. A region
   whose words, counted with repetition, cannot reach ``threshold`` even if all that it shares with the item were matched
   in order is passed over: an upper bound of the score, so no result is lost by it.
4. Smith-Waterman alignment of item and region, word by word (match +2, mismatch and gap -1), scores
   verbatim, edited and paraphrased copies alike: score / (2 x words of the item), 1 for a verbatim
   copy. Pairs from ``threshold`` on are contaminated. Steps 1 and 2 change no result: it is that of a region around
   every seed of every item.

One map over documents looks the keys of steps 1 and 2 up in a Bloom filter of the benchmark's keys: at most ``FILTER_BITS``
bits are sent, however large the benchmark grows (beyond that more documents pass it, none is lost). Documents
with a key are set aside in the checkpoint folder; their keys join the benchmark's, and the pairs, in
groups of a document and a part of its items, are aligned. No text of another document is moved and no join hint is given:
Spark broadcasts the benchmark's side if its size allows and splits hot keys if not.

Words are runs of letters, digits and underscores, lower-cased; whole texts are read.

Defined results: null and wordless documents match nothing; items with null text, a null item_id or
fewer than ``n`` words are not tested (too short to tell a copy from chance). Null doc_id and
repeated rows of documents each give their own result rows; repeated benchmark rows with the same item_id
and text are tested once. If one item matches a document more than once, the best match is given
(the earliest of equals). Empty tables give an empty result. Other input columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED_WORDS = 4
THRESHOLD = 0.5
RARE_ITEMS = 8
PAIR_KEYS = 4096
FILTER_BITS = 1 << 27
CHUNK_WORDS = 200_000
ITEM_PARTS = 16
MATCH, MISMATCH, GAP = 2, -1, -1
WORD = re.compile(r"\w+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


# ---- alignment ---------------------------------------------------------------------
def _best_end(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment score and where it ends: (score, item position, part position)."""
    j = np.arange(1, len(part) + 1)
    row, best = np.zeros(len(part) + 1, dtype=np.int64), (0, 0, 0)
    for i, w in enumerate(item):
        diag = row[:-1] + np.where(part == w, MATCH, MISMATCH)
        open_ = np.maximum(np.maximum(diag, row[1:] + GAP), 0)
        # a gap in the item, of any length: the running maximum of what it could have started from
        row = np.concatenate([[0], np.maximum.accumulate(open_ - GAP * j) + GAP * j])
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), i, at - 1)
    return best


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end): best local alignment of item with part; end exclusive, in words of part."""
    score, i, e = _best_end(item, part)
    if not score:
        return 0, 0, 0
    _, _, back = _best_end(item[:i + 1][::-1], part[:e + 1][::-1])
    return score, e - back, e + 1


# ---- index of some benchmark items ------------------------------------------------------
def build_index(items: list[tuple[int, str]], n: int = SEED_WORDS) -> dict:
    """Word ids, seed codes (sorted) and where each seed stands, for some items."""
    vocab: dict[str, int] = {}
    texts = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], dtype=np.int64) for _, t in items]
    code, item, pos = [], [], []
    for k, t in enumerate(texts):
        c = _codes(t, n)
        code.append(c)
        item.append(np.full(len(c), k))
        pos.append(np.arange(len(c)))
    code, item, pos = (np.concatenate(x) if x else np.zeros(0, t) for x, t in
                       ((code, np.uint64), (item, np.int64), (pos, np.int64)))
    order = np.lexsort((pos, item, code))
    seeds, first, inverse = np.unique(code[order], return_index=True, return_inverse=True)
    return {"n": n, "vocab": vocab, "ids": [i for i, _ in items], "texts": texts, "seeds": seeds, "item": item[order],
            "pos": pos[order], "seed": inverse, "from": first, "to": np.append(first[1:], len(order)),
            "bags": [np.unique(t, return_counts=True) for t in texts]}


def _fold(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code per run of n values."""
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    c = np.zeros(len(values) - n + 1, dtype=np.uint64)
    for k in range(n):
        c = (c ^ values[k:len(values) - n + 1 + k]) * _MULTIPLIER
        c ^= c >> np.uint64(29)
    return c


def _codes(ids: np.ndarray, n: int) -> np.ndarray:
    return _fold((ids + 1).astype(np.uint64), n)


def seed_hits(ids: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray]:
    """(position, seed) of every benchmark seed in a sequence of word ids (-1: not a benchmark word)."""
    n, seeds = index["n"], index["seeds"]
    if len(ids) < n or not len(seeds):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = np.concatenate([[0], np.cumsum(ids >= 0)])
    at = np.flatnonzero(known[n:] - known[:-n] == n)
    if not len(at):
        return at, at
    code = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        code = (code ^ (ids[at + k] + 1).astype(np.uint64)) * _MULTIPLIER
        code ^= code >> np.uint64(29)
    s = np.minimum(np.searchsorted(seeds, code), len(seeds) - 1)
    ok = seeds[s] == code
    return at[ok], s[ok]


def word_ids(text: str | None, index: dict) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(index["vocab"].get, words, repeat(-1)), dtype=np.int64, count=len(words))


def shared_words(bag: tuple[np.ndarray, np.ndarray], part: np.ndarray) -> int:
    """Words that an item (its distinct words and their counts) and a part have in common, each as often as in both."""
    known, counts = bag
    at = np.minimum(np.searchsorted(known, part), len(known) - 1)
    return int(np.minimum(np.bincount(at[known[at] == part], minlength=len(known)), counts).sum())


def matches(text: str | None, index: dict, threshold: float = THRESHOLD) -> list[dict]:
    """Contaminations of one text: item_id, score, start_word and end_word (exclusive), seeds."""
    ids = word_ids(text, index)
    at, seed = seed_hits(ids, index)
    if not len(at):
        return []
    reps = index["to"][seed] - index["from"][seed]
    row = np.concatenate([np.arange(a, b) for a, b in zip(index["from"][seed], index["to"][seed])])
    item, start, seed = index["item"][row], np.repeat(at, reps) - index["pos"][row], np.repeat(seed, reps)
    order = np.lexsort((start, item))
    item, start, seed = item[order], start[order], seed[order]
    size = np.array([len(index["texts"][k]) for k in item])
    cut = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (start[1:] - start[:-1] > size[1:])]))
    best: dict[int, dict] = {}
    for a, b in zip(cut, np.append(cut[1:], len(item))):
        k, m = int(item[a]), int(size[a])
        lo, hi = max(0, int(start[a]) - m // 2), min(len(ids), int(start[b - 1]) + m + m // 2)
        # MATCH for every shared word is the most that the region can score
        if shared_words(index["bags"][k], ids[lo:hi]) / m < max(threshold, best.get(k, {"score": 0.0})["score"]):
            continue
        score, s, e = align(index["texts"][k], ids[lo:hi])
        value = score / (MATCH * m)
        if value >= threshold and value > best.get(k, {"score": 0.0})["score"]:
            best[k] = {"item_id": index["ids"][k], "score": value, "start_word": lo + s, "end_word": lo + e,
                       "seeds": len(np.unique(seed[a:b]))}
    return [best[k] for k in sorted(best)]


# ---- keys: what a document and an item must share --------------------------------------
def word_hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=True)


def _mix(x: np.ndarray, tag: int) -> np.ndarray:
    x = (x ^ np.uint64((tag * 0x9E3779B97F4A7C15) % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def seed_key(code: np.ndarray) -> np.ndarray:
    return _mix(code, 1)


def mark_key(code: np.ndarray, size_class: int) -> np.ndarray:
    """Says that an item of this size class (its words are at most 2 to that power) holds the common seed."""
    return _mix(code, 2 + size_class)


def pair_key(code: np.ndarray, word: np.ndarray, size_class: int) -> np.ndarray:
    return _mix(_mix(code, 64 + size_class) ^ word, 0)


def bit_positions(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Places of each key in a filter of ``bits`` bits (a power of two)."""
    step = _mix(keys, 200) | np.uint64(1)
    for k in range(4):
        yield (keys + np.uint64(k) * step) & np.uint64(bits - 1)


def in_filter(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Indexes of the keys that the filter may hold; most keys fail at their first place."""
    bits = 64 * len(bitmap)
    at = np.flatnonzero(_is_set(keys & np.uint64(bits - 1), bitmap))
    ok = np.ones(len(at), dtype=bool)
    for place in bit_positions(keys[at], bits):
        ok &= _is_set(place, bitmap)
    return at[ok]


def _is_set(place: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def document_keys(texts: list[str | None], bitmap: np.ndarray, classes: list[int], n: int = SEED_WORDS) -> list[np.ndarray]:
    """Distinct keys of each text that the filter may hold."""
    out, chunk, size = [], [], 0
    for t in texts:
        words = words_of(t)
        if chunk and size + len(words) > CHUNK_WORDS:
            out += _chunk_keys(chunk, bitmap, classes, n)
            chunk, size = [], 0
        chunk.append(words)
        size += len(words)
    return out + (_chunk_keys(chunk, bitmap, classes, n) if chunk else [])


def _chunk_keys(chunk: list[list[str]], bitmap: np.ndarray, classes: list[int], n: int) -> list[np.ndarray]:
    h = word_hashes([w for words in chunk for w in words])
    code = _fold(h, n)
    if not len(code):
        return [np.zeros(0, dtype=np.uint64)] * len(chunk)
    sizes = np.array([len(words) for words in chunk])
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(chunk)), sizes)
    at = np.flatnonzero(doc[:len(code)] == doc[n - 1:])
    code = code[at]
    key = seed_key(code)
    hit = in_filter(key, bitmap)
    docs, keys = [doc[at[hit]]], [key[hit]]
    for c in classes:
        hit = in_filter(mark_key(code, c), bitmap)
        reach = 3 * 2 ** c // 2 + 1
        order = hit[np.lexsort((at[hit], code[hit], doc[at[hit]]))]
        d, s, p = doc[at[order]], code[order], at[order]
        # windows of one seed that overlap are one
        cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (p[1:] - p[:-1] > 2 * reach)])) \
            if len(p) else []
        for a, b in zip(cut, np.append(cut[1:], len(p))):
            first = ends[d[a]] - sizes[d[a]]
            near = np.unique(h[max(first, p[a] - reach):min(ends[d[a]], p[b - 1] + reach)])
            key = pair_key(s[a:a + 1], near, c)
            key = key[in_filter(key, bitmap)]
            docs.append(np.full(len(key), d[a]))
            keys.append(key)
    docs, keys = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((keys, docs))
    bounds = np.searchsorted(docs[order], np.arange(len(chunk) + 1))
    return [np.unique(keys[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]


# ---- Spark: keys of the benchmark ------------------------------------------------------
def item_texts(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(k, t): distinct item texts, and (k, item_id): which items have them."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("t")) \
        .where("item_id is not null and t is not null").distinct()
    texts = items.select("t").distinct().withColumn("k", F.monotonically_increasing_id()).checkpoint()
    return texts, items.join(texts, "t").select("k", "item_id")


def item_keys(texts: DataFrame, threshold: float = THRESHOLD, n: int = SEED_WORDS, rare_items: int = RARE_ITEMS,
              pair_keys: int = PAIR_KEYS) -> DataFrame:
    """(k, key, size_class): what joins documents to items; rows with a null k only mark a common seed and its class."""
    def parts(batches):
        for b in batches:
            for k, t in zip(b["k"], b["t"]):
                h = word_hashes(words_of(t))
                if len(h) >= n:
                    seeds, (words, count) = np.unique(_fold(h, n)), np.unique(h, return_counts=True)
                    yield pd.DataFrame({"k": k, "m": len(h), "seed": [True] * len(seeds) + [False] * len(words),
                                        "code": np.concatenate([seeds, words]).view(np.int64),
                                        "n": np.concatenate([np.ones(len(seeds), np.int64), count])})

    part = texts.mapInPandas(parts, "k long, m long, seed boolean, code long, n long").checkpoint()
    part = part.join(part.groupBy("seed", "code").agg(F.count("*").alias("items")), ["seed", "code"])
    seeds, words = part.where("seed"), part.where("not seed")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("k").orderBy("items", "code").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    need = F.greatest(F.lit(1), F.ceil(F.col("m") * F.lit(threshold) - 1e-9))
    guards = words.select("k", F.col("code").alias("word"), (before <= F.col("m") - need).alias("guard")).where("guard").drop("guard")
    common = seeds.where(F.col("items") > rare_items)
    many = common.groupBy("k", "m").agg((F.count("*") * F.col("m") > pair_keys).alias("many")).select("k", "many")
    seeds = seeds.join(many, "k", "left").withColumn("direct", (F.col("items") <= rare_items) | F.coalesce("many", F.lit(False)))
    direct = seeds.where("direct").select("k", "m", "code", F.lit(None).cast("long").alias("word"))
    paired = seeds.where("not direct").select("k", "m", "code").join(guards, "k")

    def keys(batches):
        for b in batches:
            for c, part in b.assign(c=[int(m - 1).bit_length() for m in b["m"]]).groupby("c"):
                plain = part["word"].isna().to_numpy()
                code, k = part["code"].to_numpy(np.int64).view(np.uint64), part["k"].to_numpy()
                word = part["word"].fillna(0).to_numpy(np.int64).view(np.uint64)
                key = np.where(plain, seed_key(code), pair_key(code, word, c))
                marks = np.unique(mark_key(code[~plain], c))
                yield pd.DataFrame({"k": pd.Series([*k, *[None] * len(marks)], dtype="Int64"),
                                    "key": np.concatenate([key, marks]).view(np.int64),
                                    "size_class": np.concatenate([np.where(plain, -1, c), np.full(len(marks), c)])})

    # words as text: a null beside 64-bit numbers would make them floats
    both = direct.unionByName(paired).withColumn("word", F.col("word").cast("string")).withColumn("code", F.col("code").cast("string"))
    return both.mapInPandas(lambda bs: keys(b.assign(code=b["code"].astype("int64"), word=b["word"].astype("Int64")) for b in bs),
                            "k long, key long, size_class int").distinct().checkpoint()


def key_filter(keys: DataFrame, most_bits: int = FILTER_BITS) -> tuple[np.ndarray, list[int]]:
    """Bloom filter of all keys, at most ``most_bits`` bits (a power of two), and the size classes of common seeds."""
    size = keys.agg(F.count("*").alias("n"), F.collect_set("size_class").alias("c")).first()
    bits = min(most_bits, 1 << max(12, (16 * size.n - 1).bit_length()))

    def places(batches):
        for b in batches:
            at = np.concatenate(list(bit_positions(b["key"].to_numpy(np.int64).view(np.uint64), bits)))
            yield pd.DataFrame({"slot": (at >> np.uint64(6)).astype(np.int64),
                                "bit": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    if size.n:
        got = keys.select("key").mapInPandas(places, "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("bit")).toPandas()
        bitmap[got["slot"].to_numpy()] = got["bit"].to_numpy(np.int64).view(np.uint64)
    return bitmap, sorted(c for c in size.c if c >= 0)


# ---- Spark: documents --------------------------------------------------------------
def _document_keys(docs: DataFrame, keys: DataFrame, text: str, n: int) -> Column:
    """Keys of a text that the benchmark may hold; null or empty for most texts."""
    bitmap, classes = key_filter(keys)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("array<long>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([k.view(np.int64) for k in document_keys(texts.tolist(), shared.value, classes, n)], dtype=object)
    # evaluated once, also where a filter stands on it
    return found.asNondeterministic()(F.col(text))


def _aligned(aside: DataFrame, keys: DataFrame, texts: DataFrame, threshold: float, n: int) -> DataFrame:
    """(row, k, score, start_word, end_word, seeds) of the set-aside documents (row, t, keys)."""
    pairs = aside.select("row", F.explode("keys").alias("key")).join(keys.where("k is not null").select("k", "key"), "key") \
        .select("row", "k").distinct()
    parts = pairs.join(texts.withColumnRenamed("t", "item"), "k").groupBy("row", F.pmod(F.xxhash64("k"), F.lit(ITEM_PARTS)).alias("part")) \
        .agg(F.collect_list("k").alias("ks"), F.collect_list("item").alias("items"))

    def align_all(batches):
        for b in batches:
            found = [(r, m) for r, t, ks, items in zip(b["row"], b["t"], b["ks"], b["items"])
                     for m in matches(t, build_index(list(zip(ks, items)), n), threshold)]
            if found:
                yield pd.DataFrame({"row": [r for r, _ in found], **{c: [m[f] for _, m in found] for c, f in (
                    ("k", "item_id"), ("score", "score"), ("start_word", "start_word"), ("end_word", "end_word"), ("seeds", "seeds"))}})

    return aside.select("row", "t").join(parts, "row").select("row", "t", "ks", "items").mapInPandas(
        align_all, "row long, k long, score double, start_word int, end_word int, seeds int")


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, n: int = SEED_WORDS,
                   doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", rare_items: int = RARE_ITEMS, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, seeds): every contaminated pair."""
    texts, ids = item_texts(benchmark, item_id, item_text)
    keys = item_keys(texts, threshold, n, rare_items, pair_keys)
    aside = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), _document_keys(docs, keys, text, n).alias("keys")) \
        .where(F.size("keys") > 0).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    found = _aligned(aside, keys, texts, threshold, n)
    return found.join(ids, "k").join(aside.select("row", "doc_id"), "row").select(
        "doc_id", "item_id", "score", "start_word", "end_word", "seeds")


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, n: int = SEED_WORDS,
               doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", rare_items: int = RARE_ITEMS, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, all columns.

    Documents without a key pass at once; only those set aside are joined, by a row number of their own.
    """
    texts, _ = item_texts(benchmark, item_id, item_text)
    keys = item_keys(texts, threshold, n, rare_items, pair_keys)
    found = _document_keys(docs, keys, text, n)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    aside = docs.select(whole, F.col(text).alias("t"), found.alias("keys")).where(F.size("keys") > 0) \
        .withColumn("row", F.monotonically_increasing_id()).checkpoint()
    dirty = _aligned(aside, keys, texts, threshold, n).select("row").distinct()
    cleared = aside.join(dirty, "row", "left_anti").select("doc.*")
    return docs.where(F.coalesce(F.size(found), F.lit(0)) <= 0).unionByName(cleared)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contaminations(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start_word", "end_word")
