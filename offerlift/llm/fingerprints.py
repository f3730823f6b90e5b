"""Document fingerprints that tell how alike two versions are.

A fingerprint is an invertible Bloom lookup sketch of a text's paragraph
digests: three tables of cells, each with a count and the exclusive or of the
digests put there. Subtracting the sketches of two versions cell by cell leaves
a sketch of what differs, since equal paragraphs cancel. Peeling takes a digest
from a cell that holds just one, removes it from its other cells, and goes on;
when all cells are empty, the recovered digests are the difference. When peeling
gets stuck, the digests are dealt by value to blocks of a few each and both
versions get a sketch per block; a block that gets stuck again is done over
with twice the cells and other hashes, at last by comparing its digests.

The likeness is the number of paragraphs that both have over the number that
either has, which the sizes and the difference give.

A paragraph here is what ends with a full stop, question mark, exclamation mark
or line break; a longer run is cut every 200 characters from its start.

Everything is SQL expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAGRAPH = r"[^.!?\n]{1,200}[.!?]*"
#: Cells of each of the three tables of a fingerprint, and of a block's first sketch.
CELLS = 6
BLOCK_CELLS = 8
#: Digests that a block gets on average, and blocks that are cut from one group.
BLOCK_SIZE = 6
GROUP_BLOCKS = 16
RETRIES = 4
_ROUNDS = 10


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _checked(high: str) -> str:
    return f"({high} | pmod(xxhash64({high}), 65536L))"


def digests(text: str) -> str:
    """SQL for the distinct paragraph digests of ``text``; the low 16 bits check the others."""
    pattern = PARAGRAPH.replace("\\", "\\\\")
    high = "shiftleft(shiftrightunsigned(xxhash64(u), 16), 16)"
    found = f"regexp_extract_all({text}, '{pattern}', 0)"
    return f"array_distinct(transform({found}, u -> {_let(high, 'hi', _checked('hi'))}))"


def _placed(keys: str, cells: int, salt: int) -> str:
    """Digests with their cell in each of three tables."""
    places = ", ".join(
        f"{t * cells} + cast(pmod(xxhash64(pk, {3 * salt + t}), {cells}) as int) as p{t}"
        for t in range(3)
    )
    return f"transform({keys}, pk -> struct(pk as k, {places}))"


def sketch(keys: str, cells: int, salt: int = 0) -> str:
    """SQL for an array of cells ``n, x``, those of the three tables one after another."""

    def table(t: int) -> str:
        here = f"filter(pl, e -> e.p{t} = ci)"
        cell = "struct(size(fc) as n, aggregate(fc, 0L, (a, e) -> a ^ e.k) as x)"
        places = f"sequence({t * cells}, {(t + 1) * cells - 1})"
        return f"transform({places}, ci -> {_let(here, 'fc', cell)})"

    tables = ", ".join(map(table, range(3)))
    return _let(_placed(keys, cells, salt), "pl", f"concat({tables})")


def _difference(first: str, second: str) -> str:
    return f"zip_with({first}, {second}, (u, v) -> struct(u.n - v.n as n, u.x ^ v.x as x))"


def peeled(left: str, cells: int, salt: int = 0) -> str:
    """SQL for the number of digests in a subtracted sketch, or -1 if peeling gets stuck."""
    high = "shiftleft(shiftrightunsigned(c.x, 16), 16)"
    single = f"filter(st.c, c -> abs(c.n) = 1 and c.x = {_checked(high)})"
    single = f"array_distinct(transform({single}, c -> struct(c.x as k, c.n as g)))"
    places = ", ".join(
        f"{t * cells} + cast(pmod(xxhash64(s.k, {3 * salt + t}), {cells}) as int) as p{t}"
        for t in range(3)
    )
    single = f"transform({single}, s -> struct(s.k as k, s.g as g, {places}))"
    removed = (
        "transform(st.c, (c, i) -> aggregate(filter(pu, e -> i = e.p0 or i = e.p1 or i = e.p2), c,"
        " (a, e) -> struct(a.n - e.g as n, a.x ^ e.k as x)))"
    )
    after = (
        f"if(size(pu) = 0, struct(st.c as c, st.f as f, true as done),"
        f" struct({removed} as c, st.f + size(pu) as f, false as done))"
    )
    step = f"if(st.done, st, {_let(single, 'pu', after)})"
    start = f"struct({left} as c, 0 as f, false as done)"
    end = "if(forall(st.c, c -> c.n = 0 and c.x = 0L), st.f, -1)"
    return f"aggregate(sequence(1, {_ROUNDS}), {start}, (st, r) -> {step}, st -> {end})"


def _blocks(a: str, b: str) -> str:
    """SQL for small pairs of sets that ``a`` and ``b`` are dealt to by value."""
    groups = f"(size({a}) + size({b})) div {BLOCK_SIZE * GROUP_BLOCKS} + 1"

    def dealt(keys: str, parts: str, number: str, by: int) -> str:
        return f"filter({keys}, gk -> pmod(shiftrightunsigned(gk, {by}), {parts}) = {number})"

    def pair(x: str, y: str, *how) -> str:
        return f"struct({dealt(x, *how)} as a, {dealt(y, *how)} as b)"

    grouped = f"transform(sequence(0L, gn - 1), gi -> {pair(a, b, 'gn', 'gi', 28)})"
    blocks = (
        f"flatten(transform({grouped}, gr -> transform(sequence(0, {GROUP_BLOCKS - 1}),"
        f" bi -> {pair('gr.a', 'gr.b', str(GROUP_BLOCKS), 'bi', 20)})))"
    )
    return _let(groups, "gn", f"filter({blocks}, bl -> size(bl.a) + size(bl.b) > 0)")


def with_difference(
    rows: DataFrame, a: str, b: str, sketch_a: str, sketch_b: str, name: str
) -> DataFrame:
    """``rows`` with the number of digests that only one of the sets ``a`` and ``b`` has.

    The sketches of all digests are tried first. Each retry is a step of its
    own, over the blocks that the one before could not peel.
    """
    columns = rows.columns
    first = peeled(_difference(sketch_a, sketch_b), CELLS)
    rows = rows.select("*", F.expr(first).alias("__d"))
    none = "cast(array() as array<struct<a:array<bigint>,b:array<bigint>>>)"
    rows = rows.select(
        *columns,
        F.expr("greatest(__d, 0)").alias("__sum"),
        F.expr(f"if(__d >= 0, {none}, {_blocks(a, b)})").alias("__blocks"),
    )
    for retry in range(1, RETRIES + 1):
        cells = BLOCK_CELLS << (retry - 1)
        left = _difference(sketch("bl.a", cells, retry), sketch("bl.b", cells, retry))
        tried = f"transform(__blocks, bl -> struct({peeled(left, cells, retry)} as d, bl as bl))"
        rows = rows.select(*columns, "__sum", F.expr(tried).alias("__tried"))
        rows = rows.select(
            *columns,
            F.expr("aggregate(__tried, __sum, (t, x) -> t + greatest(x.d, 0))").alias("__sum"),
            F.expr("transform(filter(__tried, x -> x.d < 0), x -> x.bl)").alias("__blocks"),
        )
    rest = (
        "aggregate(__blocks, __sum, (t, bl) ->"
        " t + size(array_except(bl.a, bl.b)) + size(array_except(bl.b, bl.a)))"
    )
    return rows.select(*columns, F.expr(rest).alias(name))


def likeness(a: str, b: str, differing: str) -> str:
    total = f"(size({a}) + size({b}))"
    return f"if({total} = 0, 1.0d, cast({total} - {differing} as double) / ({total} + {differing}))"


def written(cells: str) -> str:
    """SQL for a fingerprint as text: count and sum of each cell, in hexadecimal."""
    cell = "concat(lower(hex(c.n)), '.', lower(hex(c.x)))"
    return f"array_join(transform({cells}, c -> {cell}), '-')"


# --- the next document -------------------------------------------------------


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above ``key``, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds)) + 1
    all_, coarse = F.lit(bounds), F.lit(bounds[::width])
    lower = F.size(F.filter(coarse, lambda b: b <= key))
    inside = F.slice(all_, (lower - 1) * width + 1, F.lit(width))
    exact = (lower - 1) * width + F.size(F.filter(inside, lambda b: b <= key))
    return F.coalesce(F.when(lower == 0, 0).otherwise(exact), F.lit(0)).cast("int")


def with_next(
    rows: DataFrame, key: str, text: str, name: str, others: dict[str, str] | None = None
) -> DataFrame:
    """``rows`` with the text of the next row by ``key``, of the first row for the last.

    ``others`` maps further columns that are taken from the next row to their names.

    Null keys come first, equal keys in the order of their texts. Rows are dealt
    to buckets that follow each other in key order, in one shuffle; the first
    rows of a bucket go to the one before as well. Buckets are about equal
    because their bounds are approximate quantiles; only these come to the
    driver, eight for each shuffle partition.
    """
    spark = rows.sparkSession
    n = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    least, nulls, bounds = rows.agg(
        F.min(key), F.count_if(F.col(key).isNull()), F.percentile_approx(key, shares, 10 * n)
    ).first()
    bounds = sorted(set(bounds or []))
    firsts = rows.groupBy(_bucket(F.col(key), bounds).alias("b")).agg(F.min(key).alias("k"))
    firsts = {r.b: r.k for r in firsts.where("k is not null").collect()}
    bounds = sorted(k for b, k in firsts.items() if b > 0)
    bucket = _bucket(F.col(key), bounds)
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("copy"))
    first_of = F.get(F.lit(bounds), bucket - 1) if bounds else F.lit(None)
    before = F.when(
        (bucket > 0) & (F.col(key) == first_of),
        F.struct((bucket - 1).alias("bucket"), F.lit(1).alias("copy")),
    )
    is_first = F.col(key).isNull() if nulls else F.col(key) == F.lit(least)
    around = F.when(is_first, F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("copy")))
    placed = rows.select(
        "*", F.inline(F.filter(F.array(own, before, around), lambda p: p.isNotNull()))
    )
    order = Window.partitionBy("bucket").orderBy(
        F.col("copy") == 2, F.asc_nulls_first(key), F.col("copy") == 1, text
    )
    taken = {n: F.lead(c).over(order) for c, n in ({text: name} | (others or {})).items()}
    return placed.withColumns(taken).where("copy = 0").drop("bucket", "copy")


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, n_paragraphs`` of every row; equal texts have equal fingerprints."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("key", F.expr(digests("t")).alias("a"))
    return rows.select(
        F.col("key").alias(key),
        F.expr(written(sketch("a", CELLS))).alias("fingerprint"),
        F.size("a").alias("n_paragraphs"),
    )


def with_sketches(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with digests ``k_<column>`` and sketches ``s_<column>`` of text columns."""
    rows = rows.select("*", *[F.expr(digests(c)).alias(f"k_{c}") for c in columns])
    return rows.select("*", *[F.expr(sketch(f"k_{c}", CELLS)).alias(f"s_{c}") for c in columns])


def compare(pairs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``pairs`` with the likeness of column ``text`` and each of the columns in ``texts``.

    ``texts`` maps a text column to the name of its likeness. Columns
    ``fingerprint_<column>`` are added for all of them. Digests ``k_<column>``
    and sketches ``s_<column>`` that are there already are used.
    """
    columns = ["text", *texts]
    rows = with_sketches(pairs, [c for c in columns if f"s_{c}" not in pairs.columns])
    for c, name in texts.items():
        rows = with_difference(rows, "k_text", f"k_{c}", "s_text", f"s_{c}", f"d_{c}")
    likenesses = [
        F.expr(likeness("k_text", f"k_{c}", f"d_{c}")).alias(name) for c, name in texts.items()
    ]
    prints = [F.expr(written(f"s_{c}")).alias(f"fingerprint_{c}") for c in columns]
    return rows.select(*pairs.columns, *prints, *likenesses)


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are.

    The edited text has its last quarter of characters replaced by the first as
    many of the next row by key. Gives ``key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``. A null text is
    empty; two texts without a paragraph are wholly alike. Repeated rows follow
    each other, null keys come first, other columns are ignored, an empty table
    gives an empty one. A single row is its own next.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # One sketch of each text; its neighbour takes it over.
    rows = with_sketches(rows, ["text"])
    rows = with_next(rows, "key", "text", "next", {"k_text": "k_next", "s_text": "s_next"})
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - quarter),
        F.substring("next", F.lit(1), quarter),
    )
    rows = rows.select("*", edited.alias("edited"))
    made = compare(rows, {"edited": "near_edited", "next": "near_next"})
    return made.select(
        F.col("key").alias(key),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("fingerprint_text").alias("fingerprint"),
        F.col("fingerprint_edited").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
