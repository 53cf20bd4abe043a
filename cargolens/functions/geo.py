"""Geography helpers: state -> region lookup (PRJ-16), postal-code
normalisation (PRJ-17) and lane strings (PRJ-18).  Built-in expressions only."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Brazilian state -> region, North pooled with Northeast.
REGIONS = {
    "SP": "São Paulo",
    "ES": "Rest of Southeast", "MG": "Rest of Southeast", "RJ": "Rest of Southeast",
    "PR": "South", "RS": "South", "SC": "South",
    "DF": "Central-West", "GO": "Central-West", "MT": "Central-West", "MS": "Central-West",
    "AC": "North & Northeast", "AP": "North & Northeast", "AM": "North & Northeast", "PA": "North & Northeast",
    "RO": "North & Northeast", "RR": "North & Northeast", "TO": "North & Northeast", "AL": "North & Northeast",
    "BA": "North & Northeast", "CE": "North & Northeast", "MA": "North & Northeast", "PB": "North & Northeast",
    "PE": "North & Northeast", "PI": "North & Northeast", "RN": "North & Northeast", "SE": "North & Northeast",
}


def region_of(state: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """PRJ-16: state -> region through a literal map; unmapped states give null."""
    mapping = REGIONS if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.element_at(m, F.col(state) if isinstance(state, str) else state) if mapping else F.lit(None)


def region_table(nation: DataFrame, region: DataFrame) -> DataFrame:
    """State -> region as a table (for the fixture's states: nation name -> region name); joined with
    ``broadcast`` since it has one row per state."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("state"), F.col("r_name").alias("region")))


def normalise_zip(raw: Column | str) -> tuple[Column, Column]:
    """PRJ-17: postal code text -> (five-digit prefix text, error message).

    Digits only; 4-5 digits are a prefix (a dropped leading zero restored),
    7-8 digits are a full code (left-padded to 8, first five kept); anything
    else, or a prefix below 01000, is an error.  Empty input gives (null, null).
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    digits = F.regexp_replace(raw.cast("string"), r"\D", "")
    n = F.length(digits)
    prefix = (F.when(n.isin(4, 5), digits.cast("int"))
              .when(n.isin(7, 8), F.substring(F.lpad(digits, 8, "0"), 1, 5).cast("int")))
    blank = raw.isNull() | (F.trim(raw.cast("string")) == "")
    err = (F.when(blank, F.lit(None))
           .when(prefix.isNull(), F.concat(F.lit("'"), raw.cast("string"),
                                           F.lit("' is not a zip code: give the CEP or its first five digits")))
           .when(prefix < 1000, F.concat(F.lit("'"), raw.cast("string"),
                                         F.lit("' is not a valid zip code (prefixes run from 01000 to 99999)"))))
    value = F.when(err.isNull() & ~blank, F.lpad(prefix.cast("string"), 5, "0"))
    return value, err


def lane(origin: Column | str, destination: Column | str) -> Column:
    """PRJ-18: route string 'origin->destination'."""
    return F.concat_ws("->", origin, destination)
