"""Homomorphic fingerprints of documents (DataFrame functions only).

A document is the multiset of its paragraphs (lines, cut further after
punctuation so that short documents have several).  Every paragraph is hashed
to a wide vector, and the fingerprint is the sum of these vectors:

* ``total``: 8 lanes of 32 hash bits, added modulo 2**32.  Equal multisets have
  equal sums whatever their order; unequal ones differ but for chance.
* ``signs``: 128 lanes of +1 or -1, added modulo 2**32.  The angle between two
  such sums estimates the cosine of the two multisets.  (As text, their low 16
  bits.)

A fingerprint is one array of all lanes.  (Not a struct: Spark would evaluate
a struct's fields again for every use.)

Sums of lanes are homomorphic: :func:`insert` and :func:`delete` update a
fingerprint by the paragraphs that came or went, without the document.

Defined results: a null text counts as empty; the fingerprint of an empty text
is zero in every lane, like only another empty one; repeated rows have equal
fingerprints.  The next document of :func:`edit_report` follows in descending
order of the id (nulls last, equal ids by a hash of the text), and the first
one follows the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_running
from .common import shared_table

PARAGRAPH_END = r"\n+|(?<=[.,;:!?]) +"
SEEDS = 4                                    # hashes of a paragraph; two lanes of ``total`` each
SIGN_SEEDS = 2                               # of these, how many also give 64 signs each
_TOTAL, _SIGN = 2**32, 2**32


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), F.trim), lambda p: p != "")


def _sum(values: str, lane) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, h: a + lane(h))


def add_fingerprints(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """Add a fingerprint, array<bigint> of the lanes, of each text."""
    return from_paragraphs(df.withColumns({f"_p_{name}": paragraphs(t) for name, t in texts.items()}),
                           {name: f"_p_{name}" for name in texts}).drop(*[f"_p_{name}" for name in texts])


def from_paragraphs(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    """Add the fingerprints of array columns of paragraphs.

    The hashes are columns of their own, so that each is computed once."""
    def seeded(seed: int):
        return lambda p: F.xxhash64(p, F.lit(seed))

    def bits(j: int):
        # bits j and j + 32 of a hash, to be counted in the two halves of a long
        return lambda v: F.shiftrightunsigned(v, j).bitwiseAND(F.lit(2**32 + 1))

    def balance(size: Column):
        return lambda n: F.pmod(n * 2 - size, F.lit(_SIGN))

    low = F.lit(2**32 - 1)
    halves = (lambda v: v.bitwiseAND(low), lambda v: F.shiftrightunsigned(v, 32))
    hashed = df.withColumns({f"_h{s}_{name}": F.transform(c, seeded(s)) for name, c in parts.items() for s in range(SEEDS)})
    sums = {}
    for name in parts:
        h = [f"_h{s}_{name}" for s in range(SEEDS)]
        sums[f"_t_{name}"] = F.array(*[F.pmod(_sum(x, half), F.lit(_TOTAL)) for x in h for half in halves])
        sums[f"_s_{name}"] = F.array(*[_sum(x, bits(j)) for x in h[:SIGN_SEEDS] for j in range(32)])
    summed = hashed.withColumns(sums)
    prints = {}
    for name, c in parts.items():
        counts = F.flatten(F.transform(f"_s_{name}", lambda v: F.array(*[half(v) for half in halves])))
        prints[name] = F.concat(F.col(f"_t_{name}"), F.transform(counts, balance(F.size(c))))
    made = summed.withColumns(prints)
    return made.select(*df.columns, *parts)


def total(print_: Column) -> Column:
    return F.slice(print_, 1, 2 * SEEDS)


def signs(print_: Column) -> Column:
    return F.slice(print_, 2 * SEEDS + 1, 64 * SIGN_SEEDS)


def insert(a: Column, b: Column) -> Column:
    """The fingerprint of the union of two multisets."""
    return _lanes(a, b, lambda x, y: x + y)


def delete(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` after the paragraphs of ``b`` are taken out."""
    return _lanes(a, b, lambda x, y: x - y)


def _lanes(a: Column, b: Column, f) -> Column:
    return F.concat(F.zip_with(total(a), total(b), lambda x, y: F.pmod(f(x, y), F.lit(_TOTAL))),
                    F.zip_with(signs(a), signs(b), lambda x, y: F.pmod(f(x, y), F.lit(_SIGN))))


def as_text(print_: Column) -> Column:
    """Lanes as fixed-width lowercase hexadecimal digits."""
    def digits(lanes: Column, width: int) -> Column:
        return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), width, "0")), "")
    return F.concat(digits(total(print_), 8), digits(F.transform(signs(print_), lambda x: x.bitwiseAND(F.lit(2**16 - 1))), 4))


def centred(print_: Column) -> Column:
    """The sign sums as numbers around 0."""
    return F.transform(signs(print_), lambda x: F.when(x >= _SIGN // 2, x - _SIGN).otherwise(x).cast("double"))


def _dot(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def add_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add the estimated cosine (0 to 1) of pairs of fingerprint columns; exactly 1 for equal ones."""
    used = sorted({c for p in pairs.values() for c in p})
    ready = df.withColumns({f"_c_{c}": centred(F.col(c)) for c in used})
    ready = ready.withColumns({f"_n_{c}": _dot(f"_c_{c}", f"_c_{c}") for c in used}
                              | {f"_d_{name}": _dot(f"_c_{a}", f"_c_{b}") for name, (a, b) in pairs.items()})
    out = {}
    for name, (a, b) in pairs.items():
        norm = F.sqrt(F.col(f"_n_{a}") * F.col(f"_n_{b}"))
        out[name] = (F.when(F.col(a) == F.col(b), F.lit(1.0))
                     .when(norm == 0, F.lit(0.0))
                     .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(F.col(f"_d_{name}"), norm)))))
    return ready.withColumns(out).select(*df.columns, *pairs)


def order_of(docs: DataFrame) -> DataFrame:
    """One row for each distinct (id, th) of ``docs`` (id, th, text): how many rows it has, half of its characters, and
    the (id, th) that comes next in descending order of ids, the first after the last.

    Only ids, hashes and lengths are ordered, by a two-phase global rank."""
    keys = docs.groupBy("id", "th").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("text")).alias("n"))
    ranked = global_running(keys, [F.desc_nulls_last("id"), F.asc("th")], index_col="k")
    ranked = shared_table(ranked.select("id", "th", "rows", F.floor(F.col("n") / 2).cast("int").alias("half"), "k",
                                        (F.col("k") % F.col("_total_n") + 1).alias("next_k")), "order")
    after = ranked.select(F.col("id").alias("next_id"), F.col("th").alias("next_th"), F.col("k").alias("_k"))
    return shared_table(ranked.join(after, F.col("next_k") == F.col("_k")).select(
        F.col("id").alias("own_id"), F.col("th").alias("own_th"), "rows", "half", "next_id", "next_th"), "follows")


def edit_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text -- its second half replaced by as many characters from the
    beginning of the next document, or all of it -- and how alike the fingerprint is to the edited text's and to the
    next document's.

    The whole texts are shuffled once, by id; both joins read that exchange.  A document sends the one before it only
    its fingerprint and the characters that one needs.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("th"), "text")
    order = order_of(docs)
    repeats = (order.agg(F.max("rows")).first()[0] or 0) > 1
    if repeats:
        docs = docs.dropDuplicates(["id", "th"])
    # (no renaming below the exchange of the texts: both sides must have the same plan to share it)
    one = docs.alias("d")
    here = order.hint("merge").join(one, F.col("own_id").eqNullSafe(F.col("d.id")) & (F.col("own_th") == F.col("d.th"))).select(
        "own_id", "own_th", "rows", F.col("d.text").alias("text"))
    given = order.hint("merge").join(docs.alias("d"), F.col("next_id").eqNullSafe(F.col("d.id")) & (F.col("next_th") == F.col("d.th"))).select(
        "own_id", "own_th", F.col("d.text").alias("text"), F.substring(F.col("d.text"), F.lit(1), F.col("half")).alias("head"))
    given = add_fingerprints(given, {"after": F.col("text")}).select(
        F.col("own_id").alias("g_id"), F.col("own_th").alias("g_th"), "head", "after")
    both = here.hint("merge").join(given, F.col("own_id").eqNullSafe(F.col("g_id")) & (F.col("own_th") == F.col("g_th")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    # a repeated row is followed by its own repeat, the last of them by the next document
    itself = F.lit(False)
    if repeats:
        both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        itself = F.col("copy") < F.col("rows")
    head = F.when(itself, F.substring(F.col("text"), F.lit(1), half)).otherwise(F.col("head"))
    rows = both.select(F.col("own_id").alias(id_col), "text", "after", itself.alias("itself"),
                       F.concat(F.substring(F.col("text"), F.lit(1), n - half), head).alias("edited"))
    prints = add_fingerprints(rows, {"own": F.col("text"), "new": F.col("edited")})
    prints = prints.withColumn("after", F.when(F.col("itself"), F.col("own")).otherwise(F.col("after")))
    prints = add_likeness(prints, {"near_edited": ("own", "new"), "near_next": ("own", "after")})
    return prints.select(id_col, F.length("text").cast("long").alias("n_chars"),
                         F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         as_text(F.col("own")).alias("fingerprint"), as_text(F.col("new")).alias("edited_fingerprint"),
                         "near_edited", "near_next")
