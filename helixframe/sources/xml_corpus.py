"""Citation XML -> record rows, with the field rules P14-P19.

Reads one ``PubmedArticle`` element per row with ``from_xml``, under a
declared schema so no inference pass runs and only the paths below are
materialised. Files are cut into such elements first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from helixframe.session import cut_lineage

_S = Ty.StringType()


def _st(*fields):
    return Ty.StructType([Ty.StructField(n, t) for n, t in fields])


_PUBDATE = _st(("Year", _S), ("MedlineDate", _S))
_JOURNAL = _st(("JournalIssue", _st(("PubDate", _PUBDATE))), ("Title", _S))
_AUTHOR = _st(("LastName", _S), ("Initials", _S), ("CollectiveName", _S))
_ARTICLE = _st(
    ("Journal", _JOURNAL),
    ("ArticleTitle", _S),
    ("Abstract", _st(("AbstractText", Ty.ArrayType(_S)))),
    ("AuthorList", _st(("Author", Ty.ArrayType(_AUTHOR)))),
)
_MESH = _st(("DescriptorName", _st(("_VALUE", _S), ("_MajorTopicYN", _S))))
_MEDLINE = _st(
    ("PMID", _st(("_VALUE", _S), ("_Version", _S))),
    ("Article", _ARTICLE),
    ("MeshHeadingList", _st(("MeshHeading", Ty.ArrayType(_MESH)))),
)
_IDS = _st(("ArticleId", Ty.ArrayType(_st(("_VALUE", _S), ("_IdType", _S)))))
ARTICLE_SCHEMA = _st(("MedlineCitation", _MEDLINE), ("PubmedData", _st(("ArticleIdList", _IDS))))

RECORD_SCHEMA = Ty.StructType([
    Ty.StructField("pmid", _S, False),
    Ty.StructField("title", _S),
    Ty.StructField("abstract", _S),
    Ty.StructField("authors", Ty.ArrayType(_S)),
    Ty.StructField("year", Ty.IntegerType()),
    Ty.StructField("doi", _S),
    Ty.StructField("journal", _S),
    Ty.StructField("mesh_major_topics", Ty.ArrayType(_S)),
])

# Inline markup that may appear inside titles and abstract sections.
INLINE_TAGS = r"</?(i|b|u|sup|sub)>"
ROW_TAG = "PubmedArticle"
CORRUPT = "_corrupt_record"
XML_OPTIONS = {"attributePrefix": "_", "valueTag": "_VALUE", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": CORRUPT}
PARSE_SCHEMA = Ty.StructType([*ARTICLE_SCHEMA.fields, Ty.StructField(CORRUPT, _S)])


def _strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, INLINE_TAGS, "")


def format_authors(authors: Column) -> Column:
    """Collective name as is; else ``Last Initials``; else ``Last``; else skipped."""
    def one(a):
        last = F.nullif(a["LastName"], F.lit(""))
        ini = F.nullif(a["Initials"], F.lit(""))
        return (F.when(a["CollectiveName"].isNotNull(), a["CollectiveName"])
                .when(last.isNotNull() & ini.isNotNull(), F.concat(last, F.lit(" "), ini))
                .when(last.isNotNull(), last))
    return F.coalesce(F.filter(F.transform(authors, one), lambda x: x.isNotNull()),
                      F.array().cast("array<string>"))


def pub_year(pubdate: Column) -> Column:
    """``Year``; else the first 4 characters of ``MedlineDate`` when all digits; else NULL."""
    md4 = F.substring(pubdate["MedlineDate"], 1, 4)
    from_md = F.when(md4.rlike("^[0-9]{4}$"), md4)
    return F.coalesce(pubdate["Year"].try_cast("int"), from_md.try_cast("int"))


def pick_doi(ids: Column) -> Column:
    """First ``ArticleId`` with ``IdType="doi"`` of the article's own id list."""
    return F.try_element_at(F.filter(ids, lambda x: x["_IdType"] == "doi"), F.lit(1))["_VALUE"]


def join_abstract(sections: Column) -> Column:
    """Sections joined by one space (labels are attributes and never enter); '' if none."""
    return F.coalesce(F.array_join(F.transform(sections, _strip_tags), " "), F.lit(""))


def major_topics(headings: Column) -> Column:
    """Descriptor names whose own MajorTopicYN is Y, in order (qualifier flags ignored)."""
    return F.coalesce(
        F.transform(F.filter(headings, lambda h: h["DescriptorName"]["_MajorTopicYN"] == "Y"),
                    lambda h: h["DescriptorName"]["_VALUE"]),
        F.array().cast("array<string>"))


def records_from_struct(a: Column) -> list[Column]:
    """P14-P19 + P17 over a parsed article struct -> the eight record columns."""
    mc, art = a["MedlineCitation"], a["MedlineCitation"]["Article"]
    return [
        mc["PMID"]["_VALUE"].alias("pmid"),
        F.coalesce(_strip_tags(art["ArticleTitle"]), F.lit("")).alias("title"),
        join_abstract(art["Abstract"]["AbstractText"]).alias("abstract"),
        format_authors(art["AuthorList"]["Author"]).alias("authors"),
        pub_year(art["Journal"]["JournalIssue"]["PubDate"]).alias("year"),
        pick_doi(a["PubmedData"]["ArticleIdList"]["ArticleId"]).alias("doi"),
        F.coalesce(art["Journal"]["Title"], F.lit("")).alias("journal"),
        major_topics(mc["MeshHeadingList"]["MeshHeading"]).alias("mesh_major_topics"),
    ]


def parse_articles(df: DataFrame, col: str = "xml") -> DataFrame:
    """One row per input row, parsed once: the columns of ``df``, ``reason`` and the record's columns in ``record``.

    ``reason`` is null for a record; else ``empty`` (null or blank input), ``malformed`` (no well-formed XML) or
    ``no pmid``. The parse stands behind an ``explode`` of one element, which a filter on its fields is not
    pushed through, so that records and rejects may be filtered from the same result.
    """
    one = F.array(F.from_xml(F.col(col), PARSE_SCHEMA, XML_OPTIONS))
    parsed = df.select("*", F.explode(one).alias("__article"))
    a = F.col("__article")
    reason = (F.when(F.coalesce(F.trim(col), F.lit("")) == "", "empty").when(a[CORRUPT].isNotNull(), "malformed")
              .when(a["MedlineCitation"]["PMID"]["_VALUE"].isNull(), "no pmid"))
    return parsed.select(*df.columns, reason.alias("reason"), F.struct(*records_from_struct(a)).alias("record"))


def records(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason IS NULL").select("record.*")


def rejected(parsed: DataFrame, col: str = "xml") -> DataFrame:
    """The inputs that are no records, as they came, with the reason."""
    return parsed.where("reason IS NOT NULL").select(col, "reason")


def parse_xml_column(df: DataFrame, col: str = "xml", rejects: str | None = None) -> DataFrame:
    """S5 on a string column: its records. ``rejects`` names a folder to which the other rows are added as Parquet (input,
    reason); the parsed rows are then written once and read twice."""
    parsed = parse_articles(df, col)
    if rejects:
        parsed = cut_lineage(parsed)
        rejected(parsed, col).write.mode("append").parquet(rejects)
    return records(parsed)


def article_strings(spark: SparkSession, path: str) -> DataFrame:
    """XML files as one string per ``PubmedArticle`` element (column ``xml``), any number per file, with or without a root.

    Files are cut behind end tags by the text reader, so that a large file is read by many tasks, and before start
    tags, so that an article without its end spoils no other. Text outside of articles is left out. The last
    article of a file gets an end tag where it lacks just that.
    """
    text = spark.read.option("lineSep", f"</{ROW_TAG}>").text(path)
    start = f"<{ROW_TAG}[\\s/>]"
    parts = F.filter(F.split("value", f"(?={start})"), lambda x: x.rlike(f"^{start}"))
    last = F.size(parts) - 1
    return text.select(F.explode(F.transform(parts, lambda x, i: F.when(i == last, F.concat(x, F.lit(f"</{ROW_TAG}>"))).otherwise(x))).alias("xml"))


def read_pubmed_xml(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """XML files -> records; ``rejects`` as in :func:`parse_xml_column`."""
    return parse_xml_column(article_strings(spark, path), "xml", rejects)


def write_xml_documents(df: DataFrame, path: str, col: str = "xml", root: str = "PubmedArticleSet") -> None:
    """Write one article string per row as well-formed XML files: each output
    file (one per partition) is ``<root> ... </root>``."""
    import pandas as pd

    def wrap(it):
        yield pd.DataFrame({"line": [f"<{root}>"]})
        for pdf in it:
            yield pd.DataFrame({"line": pdf[col].astype(str)})
        yield pd.DataFrame({"line": [f"</{root}>"]})

    df.select(col).mapInPandas(wrap, "line string").write.text(path)
