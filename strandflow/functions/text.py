"""Text helpers: keys, file names, packed lists, sequences."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_key(sep: str, *cols: str) -> Column:
    """Composite key of columns as text, e.g. chrom:pos."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def pieces(c: Column, sep: str, n: int) -> list[Column]:
    """The first n pieces of packed text; missing pieces are NULL, extra ones dropped."""
    parts = F.split(c, sep)
    return [F.get(parts, F.lit(i)) for i in range(n)]


def tag_value(c: Column, key: str, sep: str = ";", assign: str = "=") -> Column:
    """Value of one key in a key=value list, NULL where the key is absent."""
    wanted = F.filter(F.split(c, sep), lambda kv: kv.startswith(key + assign))
    return F.substring(F.get(wanted, F.lit(0)), len(key) + len(assign) + 1, 1 << 30)


def pack_tags(**tags: Column) -> Column:
    """key=value pairs joined by semicolons, in the order given."""
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in tags.items()])


def base_name(c: Column) -> Column:
    """Path without its folders."""
    return F.regexp_replace(c, "^.*/", "")


def groomed_name(c: Column, suffix: str = "") -> Column:
    """Lower-cased base name without '.gz' and without `suffix`."""
    name = base_name(F.regexp_replace(F.lower(c), r"\.gz", ""))
    return F.regexp_replace(name, suffix.replace(".", r"\.") + "$", "") if suffix else name


def without_version(c: Column) -> Column:
    """Accession without its version suffix."""
    return F.regexp_replace(c, r"\..*$", "")


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def has_unknown_base(*cols: str) -> Column:
    """True where any of the sequences contains N."""
    found = F.col(cols[0]).contains("N")
    for c in cols[1:]:
        found = found | F.col(c).contains("N")
    return found
