"""Language identification by interpolated Kneser-Ney character models.

Texts are lower-cased; every run of other characters than letters is one blank.
``ORDER``-grams of all learning texts are counted in Spark (in the scan, then
with map-side combine) as strings of whole code points. Lower orders, their
continuation counts, the discounts and the back-off weights are made in Spark
from all of these counts, and probabilities order by order from the lowest; no
gram is left out.

The model is stored in sorted hash arrays with a log value by language, one row a
bucket of about ``PACK_BYTES``. Only ``CACHE_BYTES`` of it is broadcast: the grams that
stand most often, and single characters (a row a letter of Unicode at most). What
a document holds besides goes out as (row, gram, count), and its distinct grams
meet the arrays of their bucket. Which grams are broadcast changes the work, not
the result.

The prediction is the language of the lowest cross-entropy by character. Its
score comes from a logistic curve over the margin to the second best, and
``rejected`` marks documents below the score that all but ``REJECT`` of right
predictions exceed; both are calibrated on learning rows that stayed out of
the counts: those of at most ``CALIBRATION`` doc_ids (of a sixteenth, in a small
table), never all rows of a language. All other learning rows are counted.

Defined results: null texts and texts without a letter are `und` with score 0;
without learning rows every text is `und`; rows with a null doc_id, lang or
text teach nothing; repeated rows count as often as they stand there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import mix, slices, starts_of, stored

ORDER = 4
CACHE_BYTES = 16 << 20
PACK_BYTES = 8 << 20
CALIBRATION = 4_000
REPEATS = 16
REJECT = 0.005
UND = "und"
MULT = np.uint64(0x9E3779B97F4A7C15)
EDGE = 32

_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters; made once a process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, ORDER - 1 blanks before each text and one after;
    the text each point belongs to; and whether each text has a letter."""
    letters = letter_table()
    joined = [(" " * (ORDER - 1)) + (t or "").lower() + " " for t in texts]
    lens = np.fromiter(map(len, joined), np.int64, len(joined))
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), lens)
    is_letter = letters[codes]
    # keep the leading pad, letters, and the first of each run of others
    first = starts_of(lens)[:-1]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    for k in range(ORDER - 1):
        keep[first + k] = True
    after = first + ORDER - 1
    keep[after] = is_letter[after]
    codes = np.where(is_letter, codes, EDGE)[keep]
    has = np.bincount(owner, is_letter, len(texts)) > 0
    return codes.astype(np.uint64), owner[keep], has


def _grams(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the predicted characters (all but the leading pad) and their owners."""
    at = np.arange(ORDER - 1, len(codes))
    same = owner[at] == owner[at - (ORDER - 1)]
    return at[same], owner[at[same]]


def _hash(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each place."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n - 1, -1, -1):
        h = h * MULT + codes[at - k] + np.uint64(1)
    return mix(h + np.uint64(n))


def _count(batches):
    for b in batches:
        texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
        by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for x, y in slices(texts):
            codes, owner, _ = _codes(texts[x:y])
            at, who = _grams(codes, owner)
            names = sorted(set(langs[x:y]))
            number = {n: i for i, n in enumerate(names)}
            lang = np.array([number[n] for n in langs[x:y]])[who]
            h = _hash(codes, at, ORDER)
            for i, n in enumerate(names):
                mine = lang == i
                _, first, c = np.unique(h[mine], return_index=True, return_counts=True)
                by_lang.setdefault(n, []).append((_written(codes, at[mine][first]), c))
        for n, parts in by_lang.items():
            grams, c = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(grams)), pa.array(grams.tolist(), pa.string()), pa.array(c.astype(np.int64))], ["lang", "gram", "n"]
            )


def _written(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ORDER characters that end at each place, as strings."""
    if not len(at):
        return np.zeros(0, f"<U{ORDER}")
    m = np.stack([codes[at - k] for k in range(ORDER - 1, -1, -1)], 1).astype("<u4")
    return np.ascontiguousarray(m).view(f"<U{ORDER}").ravel()


class Tables:
    """Kneser-Ney models of all languages. Languages are numbers in order of their names.

    ``grams`` has a row for each gram of 1 to ORDER characters with max(n -
    discount, 0) / total by language, ``contexts`` one for each context of 0 to
    ORDER - 1 characters with its back-off weights. ``by_order`` holds the
    interpolated probabilities p[language] of all grams of an order, made from those
    of the order below. ``packs`` has one row a bucket: sorted hashes of the grams
    of the two highest orders and of their contexts, with a log value by language;
    the buckets go by the two characters before the last, which a gram shares with
    its suffix and with both contexts, so a gram is looked up in one bucket."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        spark, self.langs = counts.sparkSession, langs
        numbers = spark.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, l int")
        upper = counts.join(F.broadcast(numbers), "lang").select(F.lit(ORDER).alias("o"), "l", "gram", "n")
        orders = upper
        for o in range(ORDER - 1, 0, -1):  # n is the number of left contexts
            lower = upper.groupBy("l", F.substring("gram", 2, o).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            upper = stored(lower.select(F.lit(o).alias("o"), "l", "gram", "n"), f"grams{o}")
            orders = orders.unionByName(upper)
        orders = orders.withColumn("ctx", F.expr("substring(gram, 1, o - 1)"))
        once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        few = orders.groupBy("o", "l").agg(once.alias("once"), twice.alias("twice")).collect()  # a row an order and language
        discount = [(r.o, r.l, r.once / (r.once + 2 * r.twice) if r.once else 0.5) for r in few]
        discount = F.broadcast(spark.createDataFrame(discount, "o int, l int, discount double"))
        orders = orders.join(discount, ["o", "l"])
        sums = orders.groupBy("o", "l", "ctx").agg(
            F.sum("n").alias("total"), (F.first("discount") * F.count(F.lit(1)) / F.sum("n")).alias("v")
        )
        sums = stored(sums, "sums")
        by_lang = F.map_from_entries(F.collect_list(F.struct("l", "v"))).alias("by_lang")
        self.contexts = stored(sums.groupBy("o", "ctx").agg(by_lang), "contexts")
        kept = orders.join(sums.drop("v").hint("merge"), ["o", "l", "ctx"])
        kept = kept.withColumn("v", F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total"))
        self.grams = stored(kept.groupBy("o", "gram").agg(by_lang, F.sum("n").alias("n")), "model")
        #: distinct characters and one for all others
        self.size = self.grams.where("o = 1").count() + 1
        whole = self.contexts.where("o = 1").first().by_lang  # the empty context
        #: by language, the probability of a character that no text has
        self.floor = [whole.get(i, 1.0) / self.size for i in range(len(langs))]
        self.by_order: dict[int, DataFrame] = {}
        for o in range(1, ORDER + 1):
            self.by_order[o] = stored(self._interpolated(o), f"order{o}")
        self.single = self._single()
        self.packs, self.buckets = self._packed()

    def _interpolated(self, o: int) -> DataFrame:
        """(gram, n, p array<double>) of all grams of ``o`` characters."""
        here = self.grams.where(F.col("o") == o).select(
            "gram", "n", F.col("by_lang").alias("own"),
            F.substring("gram", 1, o - 1).alias("ctx"), F.substring("gram", 2, o - 1).alias("suffix"),
        )
        if o == 1:
            low = F.array(*map(F.lit, self.floor))
            p = F.transform(low, lambda x, i: x + F.coalesce(F.try_element_at("own", i), F.lit(0.0)))
            return here.select("gram", "n", p.alias("p"))
        weights = self.contexts.where(F.col("o") == o).select("ctx", F.col("by_lang").alias("weight"))
        here = here.join(weights.hint("merge"), "ctx")
        lower = self.by_order[o - 1].select(F.col("gram").alias("suffix"), F.col("p").alias("low"))
        here = here.join(lower.hint("merge"), "suffix")

        def value(low: Column, i: Column) -> Column:
            own = F.coalesce(F.try_element_at("own", i), F.lit(0.0))
            return own + F.coalesce(F.try_element_at("weight", i), F.lit(1.0)) * low

        return here.select("gram", "n", F.transform("low", value).alias("p"))

    def _weights(self, o: int) -> DataFrame:
        """(gram, p): the back-off weights of the contexts of order ``o`` by language."""
        each = F.transform(F.array(*[F.lit(1.0)] * len(self.langs)), lambda x, i: F.coalesce(F.try_element_at("by_lang", i), x))
        return self.contexts.where(F.col("o") == o).select(F.col("ctx").alias("gram"), each.alias("p"))

    def _single(self) -> "Cache":
        """Characters, alone and as contexts: a row a letter of Unicode at most."""
        both = _stacked(self.by_order[1].select("gram", "p"), False).unionByName(_stacked(self._weights(2), True))
        rows = both.select("context", "gram", F.col("p").cast("array<float>")).toArrow()
        return Cache.of(_keys(rows), _matrix(rows.column("p"), len(self.langs)))

    def _packed(self) -> tuple[DataFrame, int]:
        parts = [_stacked(self.by_order[o].select("gram", "p"), False) for o in (ORDER, ORDER - 1)]
        parts += [_stacked(self._weights(o), True) for o in (ORDER, ORDER - 1)]
        rows = parts[0]
        for x in parts[1:]:
            rows = rows.unionByName(x)
        size = rows.count() * (8 + 4 * len(self.langs))
        buckets = max(1, -(-size // PACK_BYTES))
        # the last two characters of a context, those before the last of a gram
        pair = F.when(F.col("context"), F.expr("right(gram, 2)")).otherwise(F.expr("left(right(gram, 3), 2)"))
        rows = rows.select(_bucket(pair, buckets), "context", "gram", F.col("p").cast("array<float>"))
        packed = rows.groupBy("bucket").applyInArrow(_pack(len(self.langs)), "bucket int, hashes array<long>, logs array<float>")
        return stored(packed, "packs"), buckets

    def evaluate(self, grams: DataFrame) -> DataFrame:
        """(gram, logs array<double>): log-probabilities by language of distinct ``grams``."""
        low = self.by_order[2].select(F.col("gram").alias("pair"), F.col("p").alias("low"))
        asked = grams.select("gram", F.expr("right(gram, 2)").alias("pair")).join(low, "pair", "left")
        asked = asked.select(_bucket(F.expr("left(right(gram, 3), 2)"), self.buckets), "gram", "low")
        single = grams.sparkSession.sparkContext.broadcast((self.single, np.log(self.floor)))
        return asked.groupBy("bucket").cogroup(self.packs.groupBy("bucket")).applyInArrow(
            _evaluate(single), "gram string, logs array<double>")

    def frequent(self) -> "Cache":
        """Grams of the highest counts that fit in CACHE_BYTES."""
        most = CACHE_BYTES // (8 + 4 * len(self.langs))
        top = self.by_order[ORDER]
        level = F.floor(F.log2("n") * 4).cast("int").alias("level")
        sizes = top.groupBy(level).count().orderBy(F.desc("level")).collect()  # 252 rows at most
        held, least = 0, 1 << 30
        for r in sizes:
            held += r["count"]
            if held > most:
                break
            least = r.level
        rows = top.where(level >= least).select(F.lit(False).alias("context"), "gram", F.col("p").cast("array<float>")).toArrow()
        return Cache.of(_keys(rows), _matrix(rows.column("p"), len(self.langs)))

    def entropies(self, docs: DataFrame, cache, keep: list[str]) -> DataFrame:
        """``keep``, has (a letter) and e, the cross-entropy by character for each
        language, for every row of ``docs``. ``cache`` is the broadcast `Cache`."""
        size = len(self.langs)
        fields = "rid long, has boolean, chars long, known array<double>, rest array<struct<gram string, n bigint>>"
        columns = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keep)
        d = docs.select(F.monotonically_increasing_id().alias("rid"), "text", *keep)
        parts = stored(d.mapInArrow(_look_up(cache, size, keep), f"{fields}, {columns}"), "parts")
        rest = parts.select("rid", F.explode("rest").alias("r")).select("rid", "r.gram", "r.n")
        found = stored(self.evaluate(rest.select("gram").distinct()), "rare")
        logs = [F.sum(F.col("n") * F.get("logs", F.lit(i))) for i in range(size)]
        more = rest.join(found.hint("merge"), "gram").groupBy("rid").agg(F.array(*logs).alias("more"))
        e = F.zip_with("known", F.coalesce("more", F.array_repeat(F.lit(0.0), size)), lambda x, y: x + y)
        return (
            parts.drop("rest")
            .join(more, "rid", "left")
            .select(*keep, "has", "chars", e.alias("sums"))
            .select(*keep, "has", F.transform("sums", lambda x: -x / F.greatest("chars", F.lit(1))).alias("e"))
        )


def _stacked(rows: DataFrame, context: bool) -> DataFrame:
    return rows.select(F.lit(context).alias("context"), "gram", "p")


def _bucket(pair: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(pair), F.lit(buckets)).cast("int").alias("bucket")


def _matrix(p: pa.ChunkedArray, size: int) -> np.ndarray:
    """Logs of a column of probability lists, as rows."""
    flat = p.combine_chunks().flatten().to_numpy().reshape(-1, size)
    return np.log(np.maximum(flat, np.float32(1e-12)))


def _keys(rows: pa.Table) -> np.ndarray:
    """Hashes of the column gram; those of contexts differ from those of grams."""
    texts = rows.column("gram").to_pylist()
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens) - 1
    out = np.zeros(len(texts), np.uint64)
    for n in np.unique(lens):
        mine = lens == n
        out[mine] = _hash(codes, ends[mine], int(n))
    context = rows.column("context").to_numpy().astype(bool)
    return np.where(context, mix(out), out)


def _pack(size: int):
    def run(rows: pa.Table) -> pa.Table:
        cache = Cache.of(_keys(rows), _matrix(rows.column("p"), size))
        n = len(cache.grams)
        return pa.Table.from_arrays(
            [
                rows.column("bucket").slice(0, 1),
                pa.ListArray.from_arrays([0, n], cache.grams.view(np.int64)),
                pa.ListArray.from_arrays([0, n * size], cache.logp.ravel()),
            ],
            ["bucket", "hashes", "logs"],
        )

    return run


def _evaluate(ref):
    """Log-probabilities of a bucket's grams, down to the order that knows them."""

    def run(asked: pa.Table, packs: pa.Table) -> pa.Table:
        single, floor = ref.value
        size, n = len(floor), asked.num_rows
        if n and packs.num_rows:
            h = packs["hashes"].combine_chunks().flatten().to_numpy().view(np.uint64)
            pack = Cache(h, packs["logs"].combine_chunks().flatten().to_numpy().reshape(-1, size))
        else:
            pack = Cache(np.zeros(0, np.uint64), np.zeros((0, size), np.float32))
        codes = np.frombuffer("".join(asked["gram"].to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        at = np.arange(n) * ORDER + ORDER - 1

        def logs(where: Cache, h: np.ndarray, missing) -> np.ndarray:
            place, there = where.find(h)
            out = np.array(np.broadcast_to(missing, (len(h), size)), float)
            out[there] = where.logp[place[there]]
            return out

        p = logs(single, _hash(codes, at, 1), floor)
        for o in range(2, ORDER + 1):
            p += logs(single if o == 2 else pack, mix(_hash(codes, at - 1, o - 1)), 0.0)
            if o == 2:
                known = asked["low"].combine_chunks()
                there = np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False)) if n else np.zeros(0, int)
                own = known.drop_null().flatten().to_numpy().reshape(-1, size) if len(there) else np.zeros((0, size))
                p[there] = np.log(np.maximum(own, 1e-12))
            else:
                place, there = pack.find(_hash(codes, at, o))
                p[there] = pack.logp[place[there]]
        lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * size, p.ravel())
        return pa.Table.from_arrays([asked["gram"], lists], ["gram", "logs"])

    return run


class Cache:
    """Sorted gram hashes with their [gram, language] log-probabilities."""

    def __init__(self, grams: np.ndarray, logp: np.ndarray):
        self.grams, self.logp = grams, logp

    @classmethod
    def of(cls, hashes: np.ndarray, logp: np.ndarray) -> "Cache":
        order = np.argsort(hashes)
        return cls(hashes[order], logp[order])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each hash."""
        if not len(self.grams):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        p = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        return p, self.grams[p] == h


def _look_up(ref, size: int, keep: list[str]):
    """Sums of the log-probabilities in the cache, and the grams outside of it."""
    rest_type = pa.struct([("gram", pa.string()), ("n", pa.int64())])

    def run(batches):
        cache = ref.value
        for b in batches:
            texts = b.column("text").to_pylist()
            for x, y in slices(texts):
                codes, owner, has = _codes(texts[x:y])
                at, who = _grams(codes, owner)
                # equal grams are looked up once a slice
                _, first, inv = np.unique(_hash(codes, at, ORDER), return_index=True, return_inverse=True)
                place, there = cache.find(_hash(codes, at[first], ORDER))
                known, hit = np.zeros((y - x, size)), there[inv]
                for i in range(size if hit.any() else 0):
                    known[:, i] = np.bincount(who[hit], cache.logp[:, i][place[inv[hit]]], y - x)
                pairs, n = np.unique(who[~hit] * len(first) + inv[~hit], return_counts=True)
                row, gram = np.divmod(pairs, max(len(first), 1))
                grams = pa.array(_written(codes, at[first][gram]).tolist(), pa.string())
                rest = pa.StructArray.from_arrays([grams, pa.array(n.astype(np.int64))], fields=list(rest_type))
                ends = np.searchsorted(row, np.arange(y - x + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("rid").slice(x, y - x),
                        pa.array(has),
                        pa.array(np.bincount(who, minlength=y - x).astype(np.int64)),
                        pa.ListArray.from_arrays(np.arange(y - x + 1, dtype=np.int32) * size, known.ravel()),
                        pa.ListArray.from_arrays(ends, rest),
                        *(b.column(k).slice(x, y - x) for k in keep),
                    ],
                    ["rid", "has", "chars", "known", "rest", *keep],
                )

    return run


def _margins(scored: DataFrame, langs: int) -> DataFrame:
    """Adds best (language number) and margin to the second best to rows with e."""
    ranked = F.array_sort(F.transform("e", lambda x, i: F.struct(x.alias("e"), i.alias("i"))))
    d = scored.withColumn("ranked", ranked)
    second = F.get("ranked", F.lit(1))["e"] - F.get("ranked", F.lit(0))["e"]
    margin = second if langs > 1 else F.lit(1.0)
    return d.withColumn("best", F.get("ranked", F.lit(0))["i"]).withColumn("margin", margin).drop("ranked", "e")


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic fit (Newton, with a small ridge)."""
    w = np.array([1.0, 0.0])
    z = np.stack([x, np.ones(len(x))], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + 0.01 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -5, 5)
    return float(max(w[0], 0.0)), float(w[1])


class Identifier:
    """Score and rejection, calibrated on held-out rows; without any it is certain of nothing."""

    def __init__(self, known: pa.Table | None = None):
        self.slope, self.offset, self.reject = 20.0, 0.0, 0.0
        if known is not None and known.num_rows >= 20:
            margin, good = known.column("margin").to_numpy(), known.column("good").to_numpy().astype(float)
            order = np.lexsort((good, margin))
            margin, good = margin[order], good[order]
            self.slope, self.offset = _logistic(margin, good)
            fine = self.score(margin)[good > 0]
            self.reject = float(np.quantile(fine, REJECT)) if len(fine) else 0.0

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))

    def scored(self, rows: DataFrame, name: Column) -> DataFrame:
        """(doc_id, lang_pred, score, rejected) of rows with has and margin."""
        at = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("margin") * self.slope + self.offset))
        found = rows.select(
            "doc_id",
            F.when(F.col("has"), name).otherwise(UND).alias("lang_pred"),
            F.when(F.col("has"), 1 / (1 + F.exp(-at))).otherwise(0.0).alias("score"),
        )
        return found.withColumn("rejected", F.col("score") < self.reject)


def split(rows: DataFrame) -> DataFrame:
    """Adds held: rows that calibrate and stay out of the counts. They are those of at
    most CALIBRATION doc_ids of a sixteenth, none of a doc_id of more than REPEATS
    rows, and none of a language that would have no other row."""
    ids = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(16)) == 0).groupBy("doc_id").count()
    ids = ids.where(F.col("count") <= REPEATS).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION)
    ids = F.broadcast(stored(ids.select("doc_id", F.lit(True).alias("picked")), "held"))
    rows = rows.join(ids, "doc_id", "left").withColumn("picked", F.coalesce("picked", F.lit(False)))
    langs = rows.groupBy("lang").agg(F.bool_and("picked").alias("only")).where("only").select("lang", "only")
    rows = rows.join(F.broadcast(langs), "lang", "left")
    return rows.withColumn("held", F.col("picked") & F.col("only").isNull()).drop("picked", "only")


def build(rows: DataFrame) -> Tables | None:
    """Models of (text, lang) rows."""
    grams = rows.select("text", "lang").mapInArrow(_count, "lang string, gram string, n long")
    counts = stored(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    return Tables(counts, langs) if langs else None


def identify(docs: DataFrame, learning: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every row of ``docs``; models come
    from all of ``learning`` (doc_id, text, lang) but the few rows they are calibrated on.
    Both kinds of rows are looked up in one pass."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = split(learning.where("doc_id is not null and text is not null and lang is not null"))
    tables = build(rows.where(~F.col("held")))
    if tables is None:
        found = d.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
        return found.withColumn("rejected", F.lit(False))
    none = F.lit(None)
    both = d.select("doc_id", "text", none.cast("string").alias("lang"), F.lit(False).alias("held")).unionByName(
        rows.where("held").select(none.cast("long").alias("doc_id"), "text", "lang", "held"))
    cache = d.sparkSession.sparkContext.broadcast(tables.frequent())
    scored = _margins(tables.entropies(both, cache, ["doc_id", "lang", "held"]), len(tables.langs))
    scored = stored(scored, "margins")
    cache.destroy()
    name = F.get(F.array(*map(F.lit, tables.langs)), F.col("best"))
    known = scored.where(F.col("held") & F.col("has")).select("margin", (name == F.col("lang")).alias("good")).toArrow()
    return Identifier(known).scored(scored.where(~F.col("held")), name)
