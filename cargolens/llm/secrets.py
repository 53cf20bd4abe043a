"""Secret scan with corpus-wide ownership (DataFrame functions only).

1. Spans of three kinds are found in every whole text: assignments of a value
   to a credential name, access keys and long hexadecimal runs.  Long bare
   tokens with letters and digits are further candidates.
2. Candidates are hashed, and the hashes counted over the corpus by distinct
   repositories and owners, in three aggregations that combine before they
   shuffle.  A value that more than ``max_owners`` owners or more than
   ``max_repositories`` repositories have is a copied example, also where one
   owner has it in all its repositories; another looks live, unless it spells a
   placeholder.
3. A live-looking bare token becomes a span of its own kind; the three base
   kinds always stay and are told apart by the counts of live ones.

Defined results: a null text is empty; a null repository or owner is one of its
own; repeated rows are scanned one by one (as copies, by the same owner).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table

# Kinds in the order of the report, patterns and least lengths.
KINDS = ("assign", "access", "hex", "bare")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BARE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 12
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your_|xxxx|(.)\1{7}"
MAX_OWNERS = 2
MAX_REPOSITORIES = 20
BLOCK = 256


def prefix_sums(df: DataFrame, arrays: list[str], suffix: str) -> DataFrame:
    """Add, for each array column, its exclusive running sums as column + suffix.

    By blocks, as an array has no scan: block totals, the totals before each
    block, and the rest inside it.  Every step is a column of its own, because
    an expression inside a lambda is evaluated for each element."""
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda s, v: s + v)

    def block_total(c: str):
        return lambda b: total(F.slice(c, b * BLOCK + 1, F.lit(BLOCK)))

    def blocks_before(c: str):
        return lambda v, b: total(F.slice(f"_t_{c}", F.lit(1), b))

    def before(c: str):
        # the offsets are named twice: an array named once would be evaluated again for every element
        def at(i):
            return F.get(f"_o_{c}", F.floor(i / BLOCK).cast("int"))
        return lambda v, i: F.when(at(i).isNotNull(), at(i)) + total(F.slice(c, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))

    blocks = df.withColumns({f"_t_{c}": F.transform(F.sequence(F.lit(0), F.ceil(F.size(c) / BLOCK).cast("int")), block_total(c))
                             for c in arrays})
    offsets = blocks.withColumns({f"_o_{c}": F.transform(f"_t_{c}", blocks_before(c)) for c in arrays})
    sums = offsets.withColumns({f"{c}{suffix}": F.transform(c, before(c)) for c in arrays})
    return sums.drop(*[f"_t_{c}" for c in arrays], *[f"_o_{c}" for c in arrays])


def spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base`` (spans of the three kinds, by start) and ``bare`` (other
    candidates), as (start, kind, end, value) in code points; drops the text.

    Matches are leftmost and do not overlap.  The text between the matches and
    the matches themselves alternate, so their lengths add up to the places."""
    kinds = list(zip(KINDS, (ASSIGN, ACCESS, HEX, BARE), (2, 0, 0, 0)))
    none = F.expr("cast(array() as array<string>)")
    text = F.coalesce(text_col, F.lit(""))
    hit = df.withColumns({f"_is_{k}": text.rlike(p) for k, p, _ in kinds})
    cut = hit.withColumns(
        {f"_m_{k}": F.when(F.col(f"_is_{k}"), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for k, p, _ in kinds}
        | {f"_v_{k}": F.when(F.col(f"_is_{k}"), F.regexp_extract_all(text, F.lit(p), F.lit(g))).otherwise(none) for k, p, g in kinds if g}
        | {f"_g_{k}": F.when(F.col(f"_is_{k}"), F.split(text, p, -1)).otherwise(none) for k, p, _ in kinds})
    cut = cut.drop(text_col, *[f"_is_{k}" for k, _, _ in kinds])
    def reach(k: str):
        return lambda m, i: (F.length(F.get(f"_g_{k}", i)) + F.length(m)).cast("long")

    def span(k: str, n: int, grouped: int):
        return lambda m, i: F.struct(
            (F.get(f"_l_{k}_before", i) + F.length(F.get(f"_g_{k}", i))).alias("start"), F.lit(n).alias("kind"),
            (F.get(f"_l_{k}_before", i) + F.get(f"_l_{k}", i)).alias("end"),
            (F.get(f"_v_{k}", i) if grouped else m).alias("value"))

    sized = cut.withColumns({f"_l_{k}": F.transform(f"_m_{k}", reach(k)) for k, _, _ in kinds})
    placed = prefix_sums(sized, [f"_l_{k}" for k, _, _ in kinds], "_before")
    found = placed.withColumns({f"_s_{k}": F.transform(f"_m_{k}", span(k, n, g)) for n, (k, _, g) in enumerate(kinds)})
    assign = F.filter("_s_assign", lambda s: F.length(s["value"]) >= LEAST_VALUE)
    graded = found.withColumn("base", F.array_sort(F.concat(assign, "_s_access", "_s_hex")))
    out = graded.withColumn("bare", F.filter("_s_bare", lambda s: (
        s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))))
    return out.select(*[c for c in df.columns if c != text_col], "base", "bare")


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repositories) from rows of (hash, owner, repository)."""
    return (candidates.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories")))


def as_text(spans_: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repository_col: str = "doc_id", max_owners: int = MAX_OWNERS,
                max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """(id, base, all_spans, n_live, n_copied): one row for each row of ``df``;
    ``n_live`` and ``n_copied`` count the base spans by the ownership of their values."""
    rows = df.select(F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
                     F.col(text_col).alias("text"))
    found = spans(rows).select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repository", "base", "bare")
    found = shared_table(found, "spans")
    each = found.filter((F.size("base") > 0) | (F.size("bare") > 0)).select(
        "row", "owner", "repository", F.explode(F.concat("base", "bare")).alias("s"))
    each = each.select("row", "owner", "repository", "s", F.sha2(F.col("s.value"), 256).alias("hash"))
    owned = ownership(each.select("hash", "owner", "repository"))
    owned = shared_table(owned.select(F.col("hash").alias("_hash"), "owners", "repositories"), "owned")
    specific = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    graded = each.join(owned, F.col("hash") == F.col("_hash")).select(
        "row", "s", (specific & ~F.col("s.value").rlike(PLACEHOLDER)).alias("live"))
    is_base = F.col("s.kind") < 3
    per_row = graded.groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(F.when(~is_base & F.col("live"), F.col("s"))).alias("added"),
        F.sum((is_base & F.col("live")).cast("long")).alias("live"), F.sum((is_base & ~F.col("live")).cast("long")).alias("copied"))
    joined = found.join(per_row, F.col("row") == F.col("_row"), "left")
    everything = F.when(F.size("added") > 0, F.array_sort(F.concat("base", "added"))).otherwise(F.col("base"))
    zero = F.lit(0).cast("long")
    return joined.select(F.col("id").alias(id_col), "base", everything.alias("all_spans"),
                         F.coalesce("live", zero).alias("n_live"), F.coalesce("copied", zero).alias("n_copied"))


def report(scan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, digest of the base spans, and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                       as_text(F.col("all_spans")).alias("spans"), "n_live", "n_copied")
