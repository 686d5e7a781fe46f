"""Text columns: Unicode strip, truncation, fallbacks, placeholders, word tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Unicode calls white space, as Java's regex spells it.
EDGE_WHITE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
PLACEHOLDER = "..."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(body: Callable[[Column], Column], **named: Column) -> Column:
    """``body`` of a struct of the named columns, each of which is computed once, also if used in lambdas."""
    bound = F.array(F.struct(*(c.alias(n) for n, c in named.items())))
    return F.element_at(F.transform(bound, body), 1)


def strip(c: Column | str) -> Column:
    """Without leading and trailing Unicode white space; null stays null."""
    return F.regexp_replace(_col(c), EDGE_WHITE, "")


def or_else(first: Column | str, *rest: Column | str) -> Column:
    """The first argument that is neither null nor empty, else null."""
    return F.coalesce(*(F.nullif(_col(c), F.lit("")) for c in (first, *rest)))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def tail_truncate(c: Column | str, most: int) -> Column:
    """Texts of over ``most`` code points become "..." and their last ``most``."""
    return F.when(F.length(_col(c)) > most, F.concat(F.lit("..."), F.right(_col(c), F.lit(most)))).otherwise(_col(c))


def head_truncate(c: Column | str, most: int) -> Column:
    return F.when(F.length(_col(c)) > most, F.concat(F.left(_col(c), F.lit(most)), F.lit("..."))).otherwise(_col(c))


def previous_text(c: Column | str, most: int = 500) -> Column:
    """A preceding description for a prompt: stripped, tail-truncated; the placeholder if blank."""
    return F.when(is_blank(c), F.lit(PLACEHOLDER)).otherwise(tail_truncate(strip(c), most))


def words(c: Column | str) -> Column:
    """Split at single spaces, keeping empties, without consecutive repeats."""
    parts = F.split(_col(c), " ")
    shifted = F.concat(F.array(F.lit(None).cast("string")), parts)
    # zipped with their predecessors once, so that the text is not split again for every word
    both = F.zip_with(parts, shifted, lambda w, p: F.struct(w.alias("w"), p.alias("p")))
    fresh = F.filter(both, lambda x: x["w"].isNotNull() & (x["p"].isNull() | (x["w"] != x["p"])))
    return F.transform(fresh, lambda x: x["w"])


def seeded_choice(options: list[str], key: Column, seed: int) -> Column:
    """A deterministic pick among the options by the key's hash."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*(F.lit(x) for x in options)), (number % len(options) + 1).cast("int"))
