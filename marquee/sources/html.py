"""Link extraction from landed pages and paged feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import as_col

# The inside of a tag up to its '>': quoted values are taken whole, so a '>' in one does not end the tag.
_INSIDE = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
# Tokens of a page, from left to right: a comment, an element whose content is no markup (with it), or a tag.
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)(?=[\s/>])" + _INSIDE + r">.*?(?:</\1\s*>|\z)"
         r"|</?[a-z]" + _INSIDE + ">")
# An attribute with its value: quoted, unquoted or none.
ATTRIBUTE = r"""(?s)[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
VALUE = r"""(?s)^[^=]*=\s*(?:"([^"]*)"|'([^']*)'|(.*))$"""
# The named character references that are decoded.
NAMED = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0"}


def decode_references(value: Column) -> Column:
    """Text with its character references (the named ones of ``NAMED``, decimal and hexadecimal) decoded, once."""
    def decoded(piece):
        out = piece
        for name, char in NAMED.items():
            out = F.when(piece == name, F.lit(char)).otherwise(out)
        digits = F.when(piece.rlike("^&#[xX]"), F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]{1,6});$", 1)).otherwise(
            F.conv(F.regexp_extract(piece, "^&#([0-9]{1,7});$", 1), 10, 16))
        code = F.conv(digits, 16, 10).cast("long")
        real = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(piece.rlike("^&#") & real, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise(out)

    pieces = F.regexp_extract_all(value, F.lit("(?s)&#?[0-9a-zA-Z]+;|[^&]+|&"), 0)
    return F.when(F.contains(value, F.lit("&")), F.array_join(F.transform(pieces, decoded), "")).otherwise(value)


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute ``name`` of a tag token, references decoded; '' without a value, NULL if absent."""
    listed = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+", ""), F.lit(ATTRIBUTE), 0)
    first = F.get(F.filter(listed, lambda a: F.lower(F.regexp_extract(a, r"^[^\s=]+", 0)) == name), F.lit(0))
    value = F.concat(*[F.regexp_extract(first, VALUE, i) for i in (1, 2, 3)])
    return decode_references(value)


def extract_links(df: DataFrame, html_col: str = "html", suffix: str | None = None,
                  keep=None) -> DataFrame:
    """One row per ``<a href>`` of each page, in page order (``link_pos`` from 0).

    ``suffix`` keeps only links ending with it (the reference keeps ``gz``). A tokenizer in built-in functions, run
    row by row on the executors: comments and the contents of scripts, styles, text areas and titles hold no links;
    values may be quoted either way or not at all; character references are decoded; the first of two ``href`` counts.
    A tag whose quote or ``>`` never comes is no tag.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != html_col]
    tags = F.filter(F.regexp_extract_all(F.col(html_col), F.lit(TOKEN), 0), lambda t: t.rlike(r"^<[aA][\s/]"))
    hrefs = F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda h: h.isNotNull())
    out = df.select(*keep, F.posexplode(hrefs).alias("link_pos", "href"))
    return out.filter(F.col("href").endswith(suffix)) if suffix else out


def match_tables(links: DataFrame, names, href_col: str = "href") -> DataFrame:
    """Pair each wanted table name with the links that contain it.

    By name, not by position: a link matches every name it contains, so a
    reordered page still pairs correctly. Links matching no name are dropped.
    """
    arr = F.array(*[F.lit(n) for n in names])
    matched = F.filter(arr, lambda n: as_col(href_col).contains(n))
    return links.select("*", F.explode(matched).alias("table_name"))


def union_pages(pages: DataFrame, results_col: str = "results", keep=None) -> DataFrame:
    """All records of all pages (``movies += results``); NULL pages add nothing."""
    keep = [c for c in (keep if keep is not None else []) if c != results_col]
    rec = pages.select(*keep, F.explode(F.col(results_col)).alias("__rec"))
    return rec.select(*keep, "__rec.*")
