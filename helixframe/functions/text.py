"""Scalar string / map / array column functions (Catalyst only, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the behaviour (they must stay as written):
# condition vocabulary of the tissue standardiser, tested in this order.
CONDITION_RULES = [
    ("metasta", "metastasis"),
    ("normal", "normal"),
    ("tumor", "tumor"),
    ("cancer", "tumor"),
    ("primary", "tumor"),
]
CONDITION_DEFAULT = "unknown"
PATIENT_PATTERN = r"AMC_(\d+)"
PATIENT_PREFIX = "P"
DEFAULT_DISEASE = "Colorectal Neoplasms"
QUERY_TEMPLATE = '"%s"[Title/Abstract] AND "%s"[MeSH Major Topic] AND hasabstract[text]'


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _trim_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parse_attrs(col) -> Column:
    """``k;;v|k;;v`` -> map<string,string>.

    Split on ``|``; fields without ``;;`` are skipped; each field splits on
    its first ``;;`` only; key and value are stripped; the last duplicate
    key wins. NULL input gives an empty map.
    """
    fields = F.filter(F.split(F.coalesce(_c(col), F.lit("")), r"\|"), lambda x: F.instr(x, ";;") > 0)
    entries = F.transform(
        fields,
        lambda x: F.struct(
            _trim_ws(F.substring_index(x, ";;", 1)).alias("key"),
            _trim_ws(F.substr(x, F.instr(x, ";;") + 2)).alias("value"),
        ),
    )
    return _last_wins_map(entries)


def _last_wins_map(entries_expr: Column) -> Column:
    # Keep an entry only if no later entry carries the same key; then the
    # map holds each key once, with the value of its last occurrence.
    kept = F.filter(
        entries_expr,
        lambda e, i: ~F.exists(F.slice(entries_expr, i + 2, F.greatest(F.size(entries_expr), F.lit(1))),
                               lambda y: y["key"] == e["key"]),
    )
    m = F.map_from_entries(kept)
    return F.when(F.size(kept) == 0, F.create_map().cast("map<string,string>")).otherwise(m)


def attr_key_to_column_name(key: str) -> str:
    """Attribute key -> column name: lower case, spaces to ``_``."""
    return key.lower().replace(" ", "_")


def standardize_condition(col) -> Column:
    """P5: free tissue text -> metastasis / normal / tumor / unknown."""
    low = F.lower(_c(col))
    expr = None
    for needle, label in CONDITION_RULES:
        cond = low.contains(needle)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(low.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(CONDITION_DEFAULT)))


def extract_patient(col) -> Column:
    """``AMC_12...`` -> ``P12``; no match -> NULL."""
    digits = F.regexp_extract(_c(col), PATIENT_PATTERN, 1)
    return F.concat(F.lit(PATIENT_PREFIX), F.nullif(digits, F.lit("")))


def strip_version(col) -> Column:
    """``ENSG00000122641.10`` -> ``ENSG00000122641`` (text before the first dot)."""
    return F.substring_index(_c(col), ".", 1)


def gene_label(symbol, gene_id) -> Column:
    """P10: symbol, else the last 15 characters of the id."""
    return F.coalesce(_c(symbol), F.right(_c(gene_id), F.lit(15)))


def build_query(gene, disease=None) -> Column:
    """Literature query text for a gene and a MeSH disease term."""
    d = F.lit(DEFAULT_DISEASE) if disease is None else _c(disease)
    return F.format_string(QUERY_TEMPLATE, _c(gene), d)


def text_base(title="title", abstract="abstract") -> Column:
    """``title \\n\\n abstract`` (the default text builder)."""
    return F.concat(_c(title), F.lit("\n\n"), _c(abstract))


def text_with_mesh(title="title", abstract="abstract", mesh="mesh_major_topics") -> Column:
    """P12 plus ``\\n\\nMeSH: t1; t2`` when the topic list is non-empty."""
    m = _c(mesh)
    suffix = F.when(F.size(m) > 0, F.concat(F.lit("\n\nMeSH: "), F.array_join(m, "; "))).otherwise(F.lit(""))
    return F.concat(text_base(title, abstract), suffix)


def render_citation(pmid="pmid", year="year", journal="journal", authors="authors",
                    title="title", abstract="abstract") -> Column:
    """P20: citation text block.

    ``PMID: p | year | journal`` / ``Authors: a, b, c`` (``...`` appended when
    there are more than three) / blank / ``Title: t`` / blank /
    ``Abstract:`` / abstract. A missing year prints as ``None``.
    """
    a = _c(authors)
    names = F.concat(F.array_join(F.slice(a, 1, 3), ", "),
                     F.when(F.size(a) > 3, F.lit("...")).otherwise(F.lit("")))
    return F.concat(F.lit("PMID: "), _c(pmid), F.lit(" | "),
                    F.coalesce(_c(year).cast("string"), F.lit("None")), F.lit(" | "), _c(journal),
                    F.lit("\nAuthors: "), names,
                    F.lit("\n\nTitle: "), _c(title),
                    F.lit("\n\nAbstract:\n"), _c(abstract))


def hit_label(pmid="id", gene="gene", distance="distance") -> Column:
    """``pmid | gene | d=0.123`` with ``?`` for a missing gene."""
    return F.format_string("%s | %s | d=%.3f", _c(pmid), F.coalesce(_c(gene), F.lit("?")), _c(distance))


def word_tokens(col) -> Column:
    """Lower-cased word tokens (letters and digits, any script), empty tokens dropped."""
    return F.filter(F.split(F.lower(_c(col)), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) > 0)


def word_tokens_nolambda(col) -> Column:
    """Same tokens as :func:`word_tokens` without a lambda (usable under explode / UDFs)."""
    return F.array_remove(F.split(F.lower(_c(col)), r"[^\p{L}\p{N}]+"), "")
