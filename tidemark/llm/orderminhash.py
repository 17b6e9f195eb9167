"""Order MinHash fingerprints of documents. DataFrame functions only.

k-mers are all overlapping runs of ``K`` bytes of a text, one from each byte on
(fewer bytes at its end), so an edit disturbs the k-mers around it and no
others, with or without spaces in the text.

The n-th occurrence of a k-mer is an element of its own.  One hash orders the
elements (the permutation) and deals them to ``SIZE`` parts.  Of each part the
``TUPLE`` least elements are selected and put in text order, and the tuple is
hashed: a component of the fingerprint survives an edit only if its elements
and their order do.

All of it happens within a row.  A k-mer is one number, 33 bits of its hash
above 31 bits of its place, and the highest bits are its part.  So sorting puts
equal k-mers side by side in text order, and then, once repeated ones have got
a new hash from the old one and their count, each part's least elements first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

K, SIZE, TUPLE = 12, 64, 2
#: k-mers begin at the bytes that are ``AT`` modulo ``EVERY``, and those without such a byte among the ``GAP`` before them: at every byte.
EVERY, AT, GAP = 1, 0, 31
#: Characters of one range of neighbouring documents, ranges of one task, and ranges beyond which their number grows by its square root.
RUN, RUNS, MANY = 1_000_000, 4, 10_000
_PLACE = 31
_PARTS = SIZE.bit_length() - 1
#: k-mers of each part that are looked at first, about; see :func:`components`.
FIRST = 24


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def kmers(text: Column, after: Column | int = 0) -> Column:
    """The k-mers of ``text`` in text order, each as ``hash << 31 | place``; those that begin beyond the first ``after`` bytes (a column, fewer than all)."""
    number = lambda h, i: F.shiftleft(F.xxhash64(h), _PLACE).bitwiseOR(i.cast("bigint"))
    after = F.lit(after) if isinstance(after, int) else after
    places, data = F.sequence(after + 1, F.greatest(F.octet_length(text), after + 1)), text.cast("binary")
    # The bytes are a lambda's own, so that they aren't taken from the text again for each k-mer.
    plain = F.flatten(F.transform(F.array(data), lambda b: F.transform(places, lambda i: number(F.substring(b, i, F.lit(K)), i))))
    # A byte's character is itself in ASCII; in other texts bytes are hashed as the characters of ISO-8859-1.
    rest = F.decode(F.substring(data, after + 1, F.octet_length(text)), "ISO-8859-1")
    other = F.transform(F.regexp_extract_all(rest, F.lit(rf"(?s)(?=(.{{1,{K}}}))."), F.lit(1)), lambda x, i: number(x, i + 1 + after))
    # Neither array can have nulls, which makes the sort after it several times as fast.
    return F.when((F.length(text) > 0) & (F.length(text) == F.octet_length(text)), plain).otherwise(other)


def _none() -> Column:
    """No numbers, in an array that can't have nulls either; a cast one could."""
    return F.slice(F.array(_long(0)), 1, 0)


def _same(a: Column, b: Column, bits: int) -> Column:
    return F.shiftrightunsigned(a.bitwiseXOR(b), bits) == 0


def _repeated(name: str) -> Column:
    """Of column ``name``, sorted k-mers, those that occurred before."""
    x = F.col(name)
    late = F.concat(F.array(F.lit(None).cast("bigint")), x)
    return F.array_remove(F.zip_with(x, late, lambda b, a: F.coalesce(F.when(_same(a, b, _PLACE), b), _long(0))), _long(0))


def _numbered(name: str) -> Column:
    """Of column ``name``, the sorted k-mers that occurred before: new ones, hashed with their occurrence."""
    r = F.col(name)
    starts = F.filter(F.sequence(F.lit(0), F.size(r) - 1), lambda j: ~F.coalesce(_same(F.get(r, j), F.get(r, j - 1), _PLACE), F.lit(False)))
    again = lambda x, k: F.shiftleft(F.xxhash64(F.shiftrightunsigned(x, _PLACE), k), _PLACE).bitwiseOR(x.bitwiseAND(_long((1 << _PLACE) - 1)))
    run = lambda s, e: F.coalesce(F.transform(F.slice(r, s + 1, e - s), again), _none())
    ends = lambda a: F.concat(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.size(r)))
    each = F.get(F.transform(F.array(starts), lambda a: F.zip_with(a, ends(a), run)), 0)
    return F.coalesce(F.when(F.size(r) > 0, F.flatten(each)), _none())


def _leading(name: str) -> Column:
    """The first ``TUPLE`` elements of each part of the sorted column ``name``."""
    x = F.col(name)
    late = F.concat(F.array(*[F.lit(None).cast("bigint")] * TUPLE), x)
    kept = F.zip_with(x, late, lambda b, a: F.when(_same(a, b, 64 - _PARTS), F.lit(0)).otherwise(b))
    return F.array_except(kept, F.array(_long(0), F.lit(None).cast("bigint")))


def _tuples(name: str) -> Column:
    """A component of each part that has elements: the part above a hash of its elements in text order."""
    c, low, mask = F.col(name), 64 - _PARTS, _long((1 << (64 - _PLACE)) - 1)
    placed = lambda x: F.shiftleft(x, 64 - _PLACE).bitwiseOR(F.shiftrightunsigned(x, _PLACE))

    def component(x: Column, j: Column) -> Column:
        mine = [placed(x), *(F.when(_same(x, F.get(c, j + k), low), placed(F.get(c, j + k))) for k in range(1, TUPLE))]
        hashed = F.xxhash64(F.transform(F.sort_array(F.array(*mine)), lambda y: y.bitwiseAND(mask)))
        return F.when(F.coalesce(_same(x, F.get(c, j - 1), low), F.lit(False)), F.lit(None)).otherwise(F.shiftleft(F.shiftrightunsigned(x, low), low).bitwiseOR(F.shiftrightunsigned(hashed, _PARTS)))

    return F.array_compact(F.transform(c, component))


def components(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """For each ``{result: column of k-mers}`` the fingerprint's components, in place of the k-mers.

    Each step is a column of its own: what a lambda reads must be a column, or it would be made again for each element.
    """

    def step(made: dict[str, object], use) -> None:
        nonlocal df
        df = df.withColumns({f"{c}_{name}": f(c) for c in columns for name, f in made.items()}).drop(*(f"{c}_{u}" for c in columns for u in use))

    low = 64 - _PARTS
    top, within = _long(1 << low), lambda x: x.bitwiseAND(_long((1 << low) - 1))
    merged = lambda c, new: F.sort_array(F.concat(new, f"{c}_n"))

    df = df.withColumns({f"{c}_s": F.sort_array(p) for c, p in columns.items()}).drop(*columns.values())
    step({"r": lambda c: _repeated(f"{c}_s")}, [])
    step({"m": lambda c: F.size(f"{c}_s") - F.size(f"{c}_r"), "n": lambda c: _numbered(f"{c}_r")}, [])
    # Of a long text only what is low in its part is sorted again.  If that gives each part all its elements, and they are low, no other comes before them; else all are sorted.
    step({"b": lambda c: F.when(F.col(f"{c}_m") <= SIZE * FIRST, top).otherwise((top / F.col(f"{c}_m")).cast("bigint") * (SIZE * FIRST))}, ["m"])
    low_ones = lambda c: F.when(F.col(f"{c}_b") == top, F.col(f"{c}_s")).otherwise(F.filter(f"{c}_s", lambda x: within(x) < F.col(f"{c}_b")))
    step({"d": lambda c: merged(c, F.array_except(low_ones(c), f"{c}_r"))}, [])
    step({"e": lambda c: _leading(f"{c}_d")}, ["d"])
    found = lambda c: (F.col(f"{c}_b") == top) | ((F.size(f"{c}_e") == SIZE * TUPLE) & F.forall(f"{c}_e", lambda x: within(x) < F.col(f"{c}_b")))
    step({"g": lambda c: F.when(found(c), _none()).otherwise(merged(c, F.array_except(f"{c}_s", f"{c}_r"))), "f": found}, ["s", "r", "n", "b"])
    step({"c": lambda c: F.when(F.col(f"{c}_f"), F.col(f"{c}_e")).otherwise(_leading(f"{c}_g"))}, ["e", "f", "g"])
    return df.withColumns({c: _tuples(f"{c}_c") for c in columns}).drop(*(f"{c}_c" for c in columns))


def likeness(a: str, b: str) -> Column:
    """Share of equal components of two fingerprints, of the parts that either has; 1 if neither has any."""
    parts = lambda c: F.transform(c, lambda x: F.shiftrightunsigned(x, 64 - _PARTS))
    seen = F.size(F.array_union(parts(a), parts(b)))
    return F.when(seen == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / seen).cast("double")


def _below(x: Column, bounds: list[int], least: bool) -> Column:
    """How many of the sorted ``bounds`` are below ``x`` (or, without ``least``, not above it): first among every k-th, then among the k after it."""
    k = max(1, int(len(bounds) ** 0.5))
    numbers = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")
    count = lambda part: F.size(F.filter(part, lambda b: b < x if least else b <= x))
    coarse = count(numbers(bounds[k - 1 :: k])) * k
    return coarse + count(F.slice(numbers(bounds), coarse + 1, F.lit(k)))


def ranged(docs: DataFrame, run: int = RUN) -> tuple[DataFrame, int]:
    """``docs(doc_id, text)`` -> ``doc_id, text, h, run``, and the number of runs.

    Runs are ranges in the order by doc_id, nulls first, then by ``h``, a hash
    of the text.  A doc_id that would fill several ranges is cut by ``h``.
    """
    key = F.coalesce("doc_id", _long(-(2**63)))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    share = (own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] or 0) / run
    runs = max(1, int(share if share < MANY else (share * MANY) ** 0.5))
    cuts = own.agg(F.percentile_approx(key, [i / runs for i in range(1, runs)], 100 * runs)).first()[0] if runs > 1 else []
    bounds = sorted(int(c) for c in cuts or [])
    own = own.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    own = own.withColumns({"__a": _below(key, bounds, True), "__b": _below(key, bounds, False)})
    g = F.col("h").cast("double") / 2.0**64 + F.when(F.col("doc_id").isNull(), 0.0).otherwise(0.5)
    several = F.col("__b") - F.col("__a")
    place = F.when(several < 2, F.col("__b")).otherwise(F.col("__a") + 1 + F.least(several - 1, F.floor(g * several)).cast("int"))
    return own.withColumn("run", place).drop("__a", "__b"), runs


def _heads(keyed: DataFrame) -> DataFrame:
    """``run, head, head_c``: for each run the text of the document after its last one, and that text's fingerprint."""
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "h")
    first = keyed.groupBy("run").agg(F.min(order).alias("first"))
    # A row a run, without any text.
    line = Window.orderBy("run")
    after = first.select(F.col("run").alias("after"), F.coalesce(F.lead("first").over(line), F.first("first").over(line.rowsBetween(Window.unboundedPreceding, 0))).alias("first"))
    texts = keyed.withColumn("first", order).join(F.broadcast(after), "first").groupBy("after").agg(F.min("text").alias("head"))
    return components(texts.withColumn("p", kmers(F.col("head"))), {"head_c": "p"}).withColumnRenamed("after", "run")


def fingerprint(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs(doc_id, text)`` -> a row for each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the beginning of the next
    document.  Fingerprints are hexadecimal components, at most one a part,
    joined by commas; null texts are empty and an empty text has no component;
    texts without any component are like each other.  Rows that share a doc_id
    follow each other; no rows give no rows; other columns are ignored.  A text
    is held whole, with some 20 bytes of k-mers for each of its bytes, by the task that reads it.
    """
    keyed, runs = ranged(docs, run)
    within = Window.partitionBy("run").orderBy(F.col("doc_id").asc_nulls_first(), "h")
    led = keyed.repartition(-(-runs // RUNS), "run").withColumn("next", F.lead("text").over(within)).join(store.table(_heads(keyed), "heads"), "run", "left")
    half = F.expr("cast(length(text) div 2 as int)")
    texts = led.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next", "head"), F.lit(1), half)))
    facts = [F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")]
    # Both texts begin alike, and so do their k-mers, up to those that reach beyond what they share.
    alike = F.greatest(F.octet_length(F.substring("text", F.lit(1), F.length("text") - half)) - (K - 1), F.lit(0))
    own = texts.select("run", "doc_id", "h", "head_c", *facts, "edited", kmers(F.col("text")).alias("p"), alike.alias("alike"))
    both = own.withColumn("q", F.concat(F.slice("p", F.lit(1), F.col("alike")), kmers(F.col("edited"), F.col("alike")))).drop("edited", "alike")
    done = components(both, {"own": "p", "other": "q"}).withColumn("next", F.coalesce(F.lead("own").over(within), "head_c"))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), ",")
    return done.select("doc_id", "n_chars", "edited_sha256", text("own").alias("fingerprint"), text("other").alias("edited_fingerprint"), likeness("own", "other").alias("near_edited"), likeness("own", "next").alias("near_next"))
