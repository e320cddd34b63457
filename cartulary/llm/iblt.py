"""Document fingerprints that tell two versions' differing paragraphs: invertible Bloom lookup sketches.

A text is its set of paragraph digests (lines cut at every sentence end; longer pieces at word borders told by
the two words there, so that edits elsewhere leave them). A sketch hashes each digest into one
cell of each of three tables; a cell holds a count, the XOR of its digests and the XOR of their checks. Two
sketches subtract cell by cell: what both texts hold cancels. A cell left with a single digest (its check
agrees) gives that digest away; taking it out of its other cells frees further ones (peeling).

The base sketch, of one size for all texts, is the fingerprint; it is compared first, inside its row. When
cells remain there, the sketch was too small for the difference: the digests are split by hash into blocks
with a larger sketch each, as many as the two texts need, and blocks that fail are made again with twice the
cells and other hashes until none is left, so the difference is always whole and always peeled. Blocks are
cells in rows: digests count +1 on one side and -1 on the other, so that the sum of a cell is the subtracted
cell, and a turn of peeling is one expansion and one aggregation. Rows lie in a table bucketed by where their
texts were dealt, so neither this nor a new try is shuffled; a single document is the largest thing that stays together.

Everything is built-in functions: no Python runs. The next document's text comes through one shuffle into
buckets of neighbouring ids, whose first rows also go to the bucket before.

Defined results: NULL text is empty; an empty text has no digest, and two of them are alike (1); rows with
NULL ids come first; repeated ids follow each other in the order of a hash of their texts; the only row of
a table is its own next; an empty table gives no row; a very long text is many digests of one row; columns
other than id and text are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, new_path

TABLES = 3
BASE_CELLS = 8  # of each table of a fingerprint
BASE_TRIED = 96  # digests of both texts, beyond which blocks are made at once
BLOCK_CELLS = 64  # of each table of a block, doubled at every new try
BLOCK_DIGESTS = 32  # a block is made for about so many
ROUNDS = 6
TURNS = 6  # of peeling a block, one table a turn
BUCKET_BYTES, PART_BYTES, MOST_PARTS = 1 << 20, 4 << 20, 100_000  # cells take some 50 times a part; Spark takes at most so many buckets of a table
PIECE_ENDS = r"\n+|(?<=[.!?])\s+|(?<=[。！？])"
LONG_PIECE = 120  # characters
WORD_ENDS = r"(?<=\s)(?=\S)|(?<=[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}])"  # scripts without spaces: every character
BORDER_WORDS = 8  # words of a part of a long piece, on average


def _long_parts(piece: Column) -> Column:
    """Digests of the parts of a long piece, cut where the hash of two neighbouring words says so."""
    at = lambda ws, i: F.pmod(F.xxhash64(F.trim(F.get(ws, i - 2)), F.trim(F.get(ws, i - 1))), F.lit(BORDER_WORDS)) == 0
    starts = lambda ws: F.filter(F.sequence(F.lit(1), F.size(ws)), lambda i: (i == 1) | at(ws, i))
    cut = lambda ws, st: F.transform(st, lambda s, n: F.xxhash64(F.slice(ws, s, F.coalesce(F.get(st, n + 1), F.size(ws) + 1) - s)))
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    return once(F.split(piece, WORD_ENDS), lambda ws: once(starts(ws), lambda st: cut(ws, st)))


def digests(text: Column) -> Column:
    """The set of paragraph digests, sorted: lines cut at sentence ends, what is still long at some word borders."""
    pieces = F.filter(F.split(F.coalesce(text, F.lit("")), PIECE_ENDS), lambda p: p != "")
    parts = F.transform(pieces, lambda p: F.when(F.length(p) > LONG_PIECE, _long_parts(p)).otherwise(F.array(F.xxhash64(p))))
    return F.array_sort(F.array_distinct(F.flatten(parts)))


NONE = "cast(array() as array<bigint>)"
ZERO = "named_struct('n', 0, 'k', 0L, 'c', 0L)"


def _once(value: str, name: str, use: str) -> str:
    """SQL for `use` of a value that is worked out once under a name."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _check(key: str) -> str:
    return f"(xxhash64({key}, 91) & 4294967295L)"


def _places(key: str, cells: int, salt: int) -> str:
    return ", ".join(f"cast(pmod(shiftright(xxhash64({key}, {salt}), {16 * t}), {cells}L) as int) as p{t}" for t in range(TABLES))


def _sketch(keys: str, cells: int, salt: int) -> str:
    """A struct of the tables t0, t1, t2, each an array of cells (n, k, c)."""
    marked = f"transform({keys}, k -> struct(k as k, {_check('k')} as c, {_places('k', cells, salt)}))"
    tables = ", ".join(
        f"transform(sequence(0, {cells - 1}), i -> aggregate(filter(ms, x -> x.p{t} = i), {ZERO}, "
        f"(y, x) -> named_struct('n', y.n + 1, 'k', y.k ^ x.k, 'c', y.c ^ x.c))) as t{t}" for t in range(TABLES))
    return _once(marked, "ms", f"struct({tables})")


def _compared(a: str, b: str, cells: int, salt: int) -> str:
    """(ok, found): subtract two sketches and peel: the digests given away, and whether every cell is empty then."""
    less = "(x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c)"
    start = _once(f"struct({_sketch(a, cells, salt)} as sa, {_sketch(b, cells, salt)} as sb)", "two", "struct(" + ", ".join(
        f"zip_with(two.sa.t{t}, two.sb.t{t}, {less}) as t{t}" for t in range(TABLES)) + f", {NONE} as found)")
    every = "concat(" + ", ".join(f"st.t{t}" for t in range(TABLES)) + ")"
    alone = (f"array_distinct(transform(filter({every}, c -> abs(c.n) = 1 and c.c = {_check('c.k')}), "
             f"c -> struct(c.k as k, c.n as n, c.c as c, {_places('c.k', cells, salt)})))")
    without = ", ".join(
        f"transform(st.t{t}, (c, i) -> aggregate(filter(ones, o -> o.p{t} = i), c, "
        f"(y, o) -> named_struct('n', y.n - o.n, 'k', y.k ^ o.k, 'c', y.c ^ o.c))) as t{t}" for t in range(TABLES))
    step = _once(alone, "ones", f"if(size(ones) = 0, st, struct({without}, concat(st.found, transform(ones, o -> o.k)) as found))")
    done = "forall(" + every.replace("st.", "pd.") + ", c -> c.n = 0 and c.k = 0)"
    return _once(f"aggregate(sequence(1, {ROUNDS}), {start}, (st, turn) -> {step})", "pd", f"struct({done} as ok, pd.found as found)")


def _check_of(k: Column) -> Column:
    return F.xxhash64(k, F.lit(91)).bitwiseAND(F.lit(0xFFFFFFFF))


def _place_of(k: Column, t: int, cells: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(k, F.lit(salt + t)), F.lit(cells).cast("long"))


def peeled(members: DataFrame, keys: list[str], cells: int, salt: int, whole: bool = True) -> DataFrame:
    """Sketches of (keys, unit, k, n: +1 or -1) subtracted and peeled: (keys, unit, place, n, k, c).

    A place is a cell of a table or, behind these, what was given away: one row a digest, or where not `whole`
    their number alone. A turn looks at one table only, in which a digest has one cell, so it is given away once.
    A unit and its place are one number `at`: few and short keys.
    """
    k, n, c, width = F.col("k"), F.col("n"), F.col("c"), TABLES * cells + 1
    of = [*keys, "at", *(["given"] if whole else [])]
    nothing = F.lit(0).cast("long")

    def cell(at: Column, n: Column, k: Column = k, c: Column = c, given: Column = nothing) -> Column:
        return F.struct(at.alias("at"), n.alias("n"), k.alias("k"), c.alias("c"), *([given.alias("given")] if whole else []))

    def place(t: int) -> Column:
        return t * cells + _place_of(k, t, cells, salt)

    def summed(df: DataFrame) -> DataFrame:
        return (df.groupBy(*of).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
                .where("n <> 0 or k <> 0 or c <> 0"))

    start = F.col("unit") * width
    out = summed(members.withColumn("c", _check_of(k)).select(*keys, F.inline(F.array(*[cell(start + place(t), n) for t in range(TABLES)]))))
    unit = F.col("at") - F.pmod("at", F.lit(width))
    for turn in range(TURNS):
        t = turn % TABLES
        alone = (F.abs(n) == 1) & (F.pmod("at", F.lit(width)) == place(t)) & (c == _check_of(k))
        own = cell(unit + width - 1, n, given=k) if whole else cell(unit + width - 1, nothing + 1)
        given = F.array(own, *[cell(unit + place(u), -n) for u in range(TABLES) if u != t])
        out = summed(out.select(*keys, F.inline(F.when(alone, given).otherwise(F.array(cell(F.col("at"), n, given=F.col("given") if whole else nothing))))))
    return out.select(*keys, F.floor(F.col("at") / width).alias("unit"), F.pmod("at", F.lit(width)).alias("place"), "n", "k", "c")


def bucketed(df: DataFrame, parts: int) -> DataFrame:
    """The rows as a table of the shared folder, bucketed by `bucket`: later groups of a bucket are not shuffled."""
    spark, name = df.sparkSession, f"kept_{uuid.uuid4().hex}"
    (df.repartition(parts, "bucket").write.format("parquet").option("compression", "zstd").option("path", new_path(spark, "kept"))
     .bucketBy(parts, "bucket").saveAsTable(name))
    return spark.table(name)


@contextmanager
def joined_in_buckets(spark: SparkSession) -> Iterator[None]:
    """What is run inside joins tables dealt by `bucket` where they lie, on that column and others, without another shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _based(df: DataFrame, pairs: Mapping[str, tuple[str, str]], whole: bool = True) -> DataFrame:
    """Adds for each pair what its base sketches give away (or, unless `whole`, how many), NULL where they are too small."""
    given = "got.found" if whole else "cast(size(got.found) as bigint)"
    same = f"struct(true as ok, {NONE} as found)"
    failed = same.replace("true", "false")
    for name, (a, b) in pairs.items():
        too_many = f"abs(size({a}) - size({b})) > {TABLES * BASE_CELLS} or size({a}) + size({b}) > {BASE_TRIED}"  # hardly ever large enough
        got = f"case when {a} = {b} then {same} when {too_many} then {failed} else {_compared(a, b, BASE_CELLS, 1)} end"
        df = df.withColumn(f"__{name}", F.expr(_once(got, "got", f"if(got.ok, {given}, null)")))
    return df


def differences(rows: DataFrame, pairs: Mapping[str, tuple[str, str]], parts: int, whole: bool = True) -> DataFrame:
    """(bucket, row, differing, found): of every pair that its base sketches left open, by larger and larger blocks.

    `rows` is a table of `_based` rows in `parts` buckets; `found`, an array of digests, only where `whole`. A pair of a row
    gives one row for each try that settled some of its blocks.
    """
    keys, names = ["bucket", "row"], list(pairs)
    sides = F.array(*[F.when(F.col(f"__{name}").isNull(), F.struct(
        F.lit(i).cast("long").alias("pair"), F.col(a).alias("a"), F.col(b).alias("b"),
        F.greatest(F.ceil((F.size(a) + F.size(b)) / BLOCK_DIGESTS), F.lit(1)).cast("long").alias("blocks"))) for i, (name, (a, b)) in enumerate(pairs.items())])
    left = rows.select(*keys, F.inline(F.filter(sides, lambda s: s.isNotNull())))
    settled, salt, cells, failing = [], 101, BLOCK_CELLS, None
    while True:
        some = left if failing is None else left.join(failing, [*keys, "pair"])
        block = F.pmod(F.xxhash64("m.k", F.lit(7)), F.col("blocks"))
        members = some.withColumn("m", F.explode(F.expr("concat(transform(a, k -> struct(k, 1L as n)), transform(b, k -> struct(k, -1L as n)))")))
        if failing is not None:
            members = members.where(F.array_contains("again", block))
        given = F.col("place") == TABLES * cells
        tables = peeled(members.select(*keys, (block * len(names) + F.col("pair")).alias("unit"), "m.k", "m.n"), keys, cells, salt, whole)
        blocks = tables.groupBy(*keys, "unit").agg(
            F.every(given).alias("ok"), F.sum(F.when(given, F.abs("n") if whole else F.col("n"))).alias("differing"),
            *([F.collect_list(F.when(given, F.col("k"))).alias("found")] if whole else []))
        of_pair = [F.coalesce(F.sum(F.when(F.col("ok"), F.col("differing"))), F.lit(0)).alias("differing"),
                   F.collect_list(F.when(~F.col("ok"), F.floor(F.col("unit") / len(names)))).alias("again")]
        if whole:
            of_pair.append(F.flatten(F.collect_list(F.when(F.col("ok"), F.col("found")))).alias("found"))
        with joined_in_buckets(rows.sparkSession):
            turn = keep(blocks.groupBy(*keys, F.pmod("unit", F.lit(len(names))).alias("pair")).agg(*of_pair))
        settled.append(turn.drop("again"))
        failing = turn.where(F.size("again") > 0).select(*keys, "pair", "again").repartition(parts, "bucket")
        if failing.isEmpty():
            break
        cells, salt = 2 * cells, salt + TABLES
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def with_differences(df: DataFrame, pairs: Mapping[str, tuple[str, str]], parts: int, whole: bool = True) -> DataFrame:
    """Adds for each pair of digest sets the digests that only one of them holds (or, unless `whole`, how many).

    `df` has columns `bucket` and `row`, which tell its rows apart; they go.
    """
    rows = bucketed(_based(df, pairs, whole), parts)
    of = lambda name, c: F.when(F.col("pair") == list(pairs).index(name), F.col(c))
    told = differences(rows, pairs, parts, whole).groupBy("bucket", "row").agg(*[
        (F.flatten(F.collect_list(of(n, "found"))) if whole else F.sum(of(n, "differing"))).alias(f"__more_{n}") for n in pairs])
    more = lambda n: F.col(f"__more_{n}")
    none = F.expr(NONE) if whole else F.lit(0).cast("long")
    out = rows.join(told, ["bucket", "row"], "left").withColumns({n: F.coalesce(F.col(f"__{n}"), more(n), none) for n in pairs})
    return out.drop("bucket", "row", *[f"__{n}" for n in pairs], *[f"__more_{n}" for n in pairs])


def with_difference(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds the paragraph digests that only one of two columns of sorted digest sets holds."""
    marked = df.withColumns({"bucket": F.spark_partition_id().cast("long"), "row": F.monotonically_increasing_id()})
    return with_differences(marked, {name: (a, b)}, max(1, df.sparkSession.sparkContext.defaultParallelism))


def likeness(a: str | Column, b: str | Column, difference: str | Column) -> Column:
    """Shared share of the paragraphs of two digest sets, from them and their difference (names of digest columns, or their numbers)."""
    number = lambda c: F.size(c) if isinstance(c, str) else c
    both, differing = number(a) + number(b), number(difference)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def fingerprint(keys: str) -> Column:
    """The base sketch as text: count, digests and checks of each cell in hexadecimal."""
    every = "concat(" + ", ".join(f"sk.t{t}" for t in range(TABLES)) + ")"
    text = f"concat_ws('', transform({every}, c -> concat(lpad(hex(c.n), 8, '0'), lpad(hex(c.k), 16, '0'), lpad(hex(c.c), 8, '0'))))"
    return F.expr(_once(_sketch(keys, BASE_CELLS, 1), "sk", text))


def parts_of(docs: DataFrame, text_col: str = "text") -> int:
    """Tasks for the texts of a table: one for each PART_BYTES, enough for all cores, no more than a table may have buckets."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]
    return int(min(MOST_PARTS, max(total // PART_BYTES, 2 * docs.sparkSession.sparkContext.defaultParallelism)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, parts: int | None = None) -> DataFrame:
    """(doc_id, text, next_text): every document with the one that follows in ascending id order, the last with the first.

    With `parts`, also both digest sets (own, next) and where the row lies (bucket, row), dealt to so many tasks.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn(
        "__k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    whole = keyed.agg(F.sum(F.octet_length("text").cast("long") + 8).alias("bytes"), F.min("__k").alias("first")).first()
    if whole["first"] is None:
        none = {"own": digests(F.col("text")), "next": digests(F.col("text")), "bucket": F.lit(0).cast("long"), "row": F.lit(0)} if parts else {}
        return keyed.select("doc_id", "text", F.col("text").alias("next_text")).withColumns(none)
    n = max(1, whole["bytes"] // bucket_bytes)
    cuts = keyed.agg(F.percentile_approx("__k", [i / n for i in range(n)], max(10_000, 10 * n)).alias("cuts")).first()["cuts"]  # one for each bucket
    bounds = sorted({whole["first"], *cuts})
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]  # two steps of look-up, so that many buckets stay cheap
    tops = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    subs = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    found = (keyed.withColumn("__top", F.size(F.filter(tops, lambda b: b <= F.col("__k"))))
             .withColumn("__sub", F.element_at(subs, F.col("__top")))
             .withColumn("__bucket", (F.col("__top") - 1) * step + F.size(F.filter("__sub", lambda b: b <= F.col("__k"))) - 1))
    here = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("wrap"), F.lit(False).alias("guest"))
    before = F.struct(F.when(F.col("__bucket") == 0, len(bounds) - 1).otherwise(F.col("__bucket") - 1).alias("bucket"),
                      F.when(F.col("__bucket") == 0, 1).otherwise(0).alias("wrap"), F.lit(True).alias("guest"))
    dealt = (found.withColumn("__to", F.explode(F.when(F.array_contains("__sub", F.col("__k")), F.array(here, before)).otherwise(F.array(here))))
             .select("doc_id", "text", "__k", "__to.*", F.xxhash64("text").alias("__tie")))
    order = Window.partitionBy("bucket").orderBy("wrap", "__k", "__tie")
    if parts:
        dealt = dealt.withColumn("bucket", F.col("bucket").cast("long")).repartition(parts, "bucket").withColumn("own", digests(F.col("text")))
    out = dealt.withColumn("next_text", F.lead("text").over(order))
    if parts:
        out = out.withColumn("next", F.lead("own").over(order)).withColumn("row", F.row_number().over(order))
    return out.where(~F.col("guest")).select("doc_id", "text", "next_text", *(["own", "next", "bucket", "row"] if parts else []))


def edited(text: Column, following: Column) -> Column:
    """The last half of a text replaced by as many of the first characters of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
