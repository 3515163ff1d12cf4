"""Secret scan: base patterns, plus tokens that look random rather than written.

Base spans come from three patterns (assignment, access key, hex run). Beyond
them, every run of ``TOKEN_CHARS`` token characters or more is scored by two
first-order character Markov models, one of random strings and one of ordinary
identifiers: the mean log-likelihood ratio of its transitions. Runs above a
threshold that overlap no base span are added under the kind `markov`.

The models are trained on labelled strings of all documents: values the base
patterns found (random, each value once; mixed with a uniform model, so that
alphabets unseen there count as random too) and identifiers of documents without
a base match, as often as they occur. Those documents hold the secrets that the
base patterns miss, so a first fit takes no identifier from runs of
``TOKEN_CHARS`` or more, which are all that can
be a secret; runs whose ratio under it is nearer the bulk of identifiers than
the base values (a quarter of them, held out; letters and digits only), and below ``MARGIN``, then join
the final fit.
Strings are counted first, so the driver holds counts of character pairs and of
ratios in steps of 1 / ``STEPS`` only; the threshold lies ``MARGIN``
above the ratio that all but one in ten thousand identifiers of the final fit
stay below, or halfway to the ratio that all but one in a hundred held-out base
values exceed, if that is less. All documents and whole texts teach and are scanned.

Only DataFrame functions are used. A pattern's pieces and matches alternate, so
running sums of their lengths give the positions: one small row for each match,
and one for each document, goes through a single shuffle.

Defined results: null and empty texts have no spans (the digest is that of '');
repeated rows each get their own result; positions are code points, ends
exclusive; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm.common import documents, stored

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN_CHARS = 20
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN_CHARS
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_-]{5,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
MARGIN = 0.1
#: Ratios are counted in steps of 1 / STEPS.
STEPS = 1000


def _found(text: Column, kind: int, pattern: str, group: int, ok) -> Column:
    """array of (kind, i, gap before, length, ok) for the matches of a pattern;
    ``ok`` judges a match by its ``group``. The arrays are zipped, so each is made
    once a text: an expression named inside a lambda is made for every element."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    if group:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        parts = F.zip_with(parts, values, lambda x, v: F.struct(x["p"].alias("p"), x["m"].alias("m"), v.alias("v")))
    rows = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(x["p"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("n"),
            ok(x["v"] if group else x["m"]).alias("ok"),
        ),
    )
    return F.when(text.rlike(pattern), F.filter(rows, lambda r: r["n"].isNotNull()))  # the last piece has no match


def _transitions(strings: DataFrame) -> dict[tuple[int, int], int]:
    """Counts of adjacent ASCII pairs over the strings ``s``, each ``n`` times."""
    chars = strings.select("n", F.split("s", "").alias("c"))
    pairs = chars.select(
        "n",
        F.explode(
            F.zip_with(
                F.slice("c", F.lit(1), F.greatest(F.size("c") - 1, F.lit(0))),
                F.slice("c", F.lit(2), F.greatest(F.size("c") - 1, F.lit(0))),
                lambda a, b: F.struct(F.ascii(a).alias("a"), F.ascii(b).alias("b")),
            )
        ).alias("p"),
    ).where("p.a between 1 and 127 and p.b between 1 and 127")
    counts = pairs.groupBy("p.a", "p.b").agg(F.sum("n").alias("times"))
    return {(r.a, r.b): r.times for r in counts.collect()}  # 127 x 127 at most


def _ratios(random: dict, ordinary: dict) -> str:
    """log P_random(b|a) - log P_ordinary(b|a) of all pairs, 128 x 128, as text."""
    size = len(ALPHABET)
    codes = [ord(c) for c in ALPHABET]

    def model(counts: dict):
        """P(b|a), backing off to P(b), which backs off to uniform."""
        after, single = dict.fromkeys(codes, 0), dict.fromkeys(codes, 0)
        for (a, b), n in counts.items():
            if a in after and b in single:
                after[a] += n
                single[b] += n
        total = sum(single.values())
        one = {b: (n + 0.5) / (total + 0.5 * size) for b, n in single.items()}
        return lambda a, b: (counts.get((a, b), 0) + 4 * one[b]) / (after[a] + 4)

    p, q = model(random), model(ordinary)
    table = [0.0] * (128 * 128)
    for a in codes:
        for b in codes:
            table[a * 128 + b] = math.log(0.5 * p(a, b) + 0.5 / size) - math.log(q(a, b))
    return ",".join(f"{x:.4f}" for x in table)


def _alphanumeric(table: str) -> str:
    """The table without a say for other characters: short identifiers hold few of them."""
    values = table.split(",")
    return ",".join(x if chr(i // 128).isalnum() and chr(i % 128).isalnum() else "0" for i, x in enumerate(values))


def _even(table: str) -> float:
    """Ratio to expect of a string of even random letters and digits."""
    values = table.split(",")
    codes = [ord(c) for c in ALPHABET if c.isalnum()]
    return sum(float(values[a * 128 + b]) for a in codes for b in codes) / len(codes) ** 2


def ratio(token: Column, table: str) -> Column:
    """Mean log-likelihood ratio of a token's transitions."""
    values = F.split(F.lit(table), ",").cast("array<double>")
    chars = F.split(token, "")
    n = F.size(chars)
    steps = F.zip_with(
        F.slice(chars, F.lit(1), n - 1),
        F.slice(chars, F.lit(2), n - 1),
        lambda a, b: F.element_at(values, F.ascii(a) * 128 + F.ascii(b) + 1),
    )
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.length(token) - 1, F.lit(1))


def _quantile(strings: DataFrame, q: float, table: str) -> float | None:
    """The ratio that a share ``q`` of the strings ``s``, each ``n`` times, does not exceed."""
    step = F.round(ratio(F.col("s"), table) * STEPS).cast("long")
    # ratios lie within those of the table, some tens of thousands of steps
    steps = sorted(strings.groupBy(step.alias("step")).agg(F.sum("n").alias("times")).collect())
    left = q * sum(r.times for r in steps)
    for r in steps:
        left -= r.times
        if left <= 0:
            return r.step / STEPS
    return steps[-1].step / STEPS if steps else None


def fit_ratios(docs: DataFrame) -> tuple[str, float]:
    """Ratio table and threshold from the labelled strings of all documents."""
    d = documents(docs).where("text is not null")
    base = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    plain = ~(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX))
    values = d.select(F.explode(base).alias("s")).where(F.length("s") >= 16).distinct()
    values = values.select("s", F.lit(1).cast("long").alias("n"), (F.pmod(F.xxhash64("s", F.lit(7)), F.lit(4)) == 0).alias("held"))
    values = stored(values, "values")

    def identifiers(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))

    def marked(found: Column, run: bool) -> Column:
        return F.transform(found, lambda x: F.struct(x.alias("s"), F.lit(run).alias("run")))

    found = F.concat(
        marked(identifiers(F.regexp_replace("text", TOKEN, " ")), False),
        marked(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)), True),
    )
    strings = d.where(plain).select(F.explode(found).alias("x")).groupBy("x.s", "x.run").agg(F.count(F.lit(1)).alias("n"))
    strings = stored(strings, "strings")
    short, runs = strings.where("not run").select("s", "n"), strings.where("run")
    held, random = values.where("held"), _transitions(values.where("not held"))

    usual = _transitions(short)
    table = _alphanumeric(_ratios(random, usual))
    bulk, base = _quantile(short, 0.5, table), _quantile(held, 0.5, table)
    if base is None:
        base = _even(table)
    cut = min(((0.0 if bulk is None else bulk) + base) / 2, MARGIN)
    near = runs.where(ratio(F.col("s"), table) < cut)
    near = stored(near.select(F.explode(identifiers(F.col("s"))).alias("s"), "n"), "identifiers")
    for pair, n in _transitions(near).items():
        usual[pair] = usual.get(pair, 0) + n
    table = _ratios(random, usual)
    top = max(_quantile(short.unionByName(near).where(F.length("s") >= 12), 0.9999, table) or 0.0, 0.0)
    low = _quantile(held.where(F.length("s") >= TOKEN_CHARS), 0.01, table)
    return table, min(top + MARGIN, (top + low) / 2) if low is not None and low > top else top + MARGIN


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<start, kind, end>>) for every row of ``docs``,
    in order of start and kind (0 to 3 as in ``KINDS``)."""
    table, threshold = fit_ratios(docs)
    text = F.coalesce("text", F.lit(""))
    d = documents(docs).select(F.monotonically_increasing_id().alias("rid"), "doc_id", text.alias("text"))
    t = F.col("text")
    none = F.array().cast("array<struct<kind:int,i:int,gap:bigint,n:bigint,ok:boolean>>")
    found = [
        _found(t, 0, ASSIGN, 2, lambda v: F.length(v) >= 6),
        _found(t, 1, ACCESS, 0, lambda m: F.lit(True)),
        _found(t, 2, HEX, 0, lambda m: F.lit(True)),
        _found(t, 3, TOKEN, 0, lambda m: ratio(m, table) > threshold),
    ]
    rows = d.select("rid", "doc_id", F.explode_outer(F.concat(*(F.coalesce(f, none) for f in found))).alias("m"))
    rows = rows.select("rid", "doc_id", "m.*").repartition("rid")
    so_far = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far)).withColumn("start", F.col("end") - F.col("n"))
    rows = rows.select("rid", "doc_id", "kind", "start", "end", F.coalesce("ok", F.lit(False)).alias("ok"))
    # an added span must end before the next base span starts and start after the last one ended
    is_base = F.col("ok") & (F.col("kind") < 3)
    upto = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("last_end", F.max(F.when(is_base, F.col("end"))).over(upto))
    rows = rows.withColumn("next_start", F.min(F.when(is_base, F.col("start"))).over(onward))
    clear = (F.coalesce("last_end", F.lit(0)) <= F.col("start")) & (F.coalesce("next_start", F.col("end")) >= F.col("end"))
    good = F.col("ok") & ((F.col("kind") < 3) | clear)
    span = F.when(good, F.struct("start", "kind", "end"))
    return rows.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("spans")).drop("rid")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
