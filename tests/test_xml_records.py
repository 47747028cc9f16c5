"""Golden XML cases for the record rules (S5, P14-P19), on XML written for these tests."""

from helixframe.sources import xml_corpus as X

ART = """<PubmedArticle><MedlineCitation><PMID Version="1">{pmid}</PMID>
<DateCompleted><Year>1999</Year></DateCompleted>
<Article><Journal><JournalIssue><PubDate>{date}</PubDate></JournalIssue><Title>Journal of Invented Results</Title></Journal>
<ArticleTitle>{title}</ArticleTitle>
<ELocationID EIdType="doi">10.1/eloc</ELocationID>
{abstract}
<AuthorList>{authors}</AuthorList></Article>
<MeshHeadingList>
<MeshHeading><DescriptorName MajorTopicYN="Y">Bryophytes</DescriptorName></MeshHeading>
<MeshHeading><DescriptorName MajorTopicYN="N">Peat Soils</DescriptorName><QualifierName MajorTopicYN="Y">genetics</QualifierName></MeshHeading>
<MeshHeading><DescriptorName MajorTopicYN="Y">Upland Survey</DescriptorName></MeshHeading>
</MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList>{ids}</ArticleIdList>
<ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/ref</ArticleId></ArticleIdList></Reference></ReferenceList>
</PubmedData></PubmedArticle>"""


def _one(spark, **kw):
    base = dict(pmid="900017", date="<Year>2011</Year>", title="Mapping <i>moss</i> &amp; lichen",
                abstract="<Abstract><AbstractText>Flat text.</AbstractText></Abstract>",
                authors="<Author><LastName>Quillon</LastName><Initials>P</Initials></Author>"
                        "<Author><LastName>Tarn</LastName><Initials>WX</Initials></Author>",
                ids='<ArticleId IdType="pubmed">900017</ArticleId>')
    base.update(kw)
    df = spark.createDataFrame([(ART.format(**base),)], "xml string")
    return X.parse_xml_column(df).first()


def test_no_doi_and_topics(spark):
    r = _one(spark)
    assert r.pmid == "900017" and r.year == 2011 and r.journal == "Journal of Invented Results"
    assert r.doi is None                      # ELocationID and reference DOIs are ignored
    assert r.mesh_major_topics == ["Bryophytes", "Upland Survey"]   # qualifier-only Y excluded
    assert r.authors == ["Quillon P", "Tarn WX"]
    assert r.title == "Mapping moss & lichen"  # inline tags stripped, entity decoded


def test_structured_abstract_labels_do_not_leak(spark):
    abs_ = ('<Abstract><AbstractText Label="BACKGROUND">First part.</AbstractText>'
            '<AbstractText Label="RESULTS">Second <sup>2</sup> part.</AbstractText></Abstract>')
    r = _one(spark, abstract=abs_)
    assert r.abstract == "First part. Second 2 part."
    assert "BACKGROUND" not in r.abstract


def test_no_abstract_and_medline_dates(spark):
    r = _one(spark, abstract="", date="<MedlineDate>2016 Autumn</MedlineDate>")
    assert r.abstract == "" and r.year == 2016
    r2 = _one(spark, date="<MedlineDate>Winter 2011</MedlineDate>")
    assert r2.year is None


def test_first_doi_and_collective_and_nameless_authors(spark):
    ids = ('<ArticleId IdType="pubmed">1</ArticleId><ArticleId IdType="doi">10.7777/moss.5</ArticleId>'
           '<ArticleId IdType="doi">10.2/second</ArticleId>')
    authors = ("<Author><CollectiveName>Bog Survey Group</CollectiveName></Author>"
               "<Author><LastName>Ostrander</LastName></Author>"
               "<Author><Initials>Z</Initials></Author>"
               "<Author><LastName>Vasquez-Hill</LastName><Initials></Initials></Author>")
    r = _one(spark, ids=ids, authors=authors)
    assert r.doi == "10.7777/moss.5"
    assert r.authors == ["Bog Survey Group", "Ostrander", "Vasquez-Hill"]


def test_record_cache_roundtrip(spark, tmp_path):
    from helixframe.operators import corpus as C
    missing = C.load_records(spark, str(tmp_path / "absent"))
    assert missing.count() == 0 and missing.schema == X.RECORD_SCHEMA
    rec = spark.createDataFrame([("77", "Fen", "", ["Q P", "T"], None, "10.7777/x", "J", []), ("78", "", "wet", [], 1987, None, "", ["Peat Soils", "x"])], X.RECORD_SCHEMA)
    C.save_records(rec, str(tmp_path / "cache"))
    back = C.load_records(spark, str(tmp_path / "cache"))
    assert sorted(back.collect()) == sorted(rec.collect())


def test_unparsed_rows_go_to_the_side_table(spark, tmp_path):
    good = ART.format(pmid="5", date="<Year>2011</Year>", title="T", abstract="", authors="", ids="")
    df = spark.createDataFrame([(good,), ("<PubmedArticle><broken",), (good.replace('<PMID Version="1">5</PMID>', ""),)], "xml string")
    side = str(tmp_path / "rejects")
    assert [r.pmid for r in X.parse_xml_column(df, rejects=side).collect()] == ["5"]
    assert sorted(r.reason for r in spark.read.parquet(side).collect()) == ["malformed", "no pmid"]
    plan = X.parse_xml_column(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") + plan.count("XmlToStructs") <= 1


def test_every_input_row_is_a_record_or_a_reject(spark):
    good = ART.format(pmid="5", date="<Year>2011</Year>", title="T", abstract="", authors="", ids="")
    rows = [good, good, None, "", "  ", "no xml", good[:300], good.replace("</Article>", "</Artcle>"), good.replace('<PMID Version="1">5</PMID>', "")]
    df = spark.createDataFrame(list(enumerate(rows)), "n int, xml string")
    parsed = X.parse_articles(df)
    assert {r.n: r.reason for r in parsed.collect()} == {0: None, 1: None, 2: "empty", 3: "empty", 4: "empty", 5: "malformed", 6: "malformed",
                                                         7: "malformed", 8: "no pmid"}
    assert X.records(parsed).count() == 2 and [r.xml for r in X.rejected(parsed).orderBy("xml").collect()].count(None) == 1
    assert X.parse_articles(df.limit(0)).count() == 0


def test_files_lose_only_the_broken_article(spark, tmp_path):
    """Several articles a file, with a root or without one, one truncated in the middle of a file and one at its end."""
    art = lambda k: ART.format(pmid=str(k), date="<Year>2011</Year>", title=f"T{k}", abstract="", authors="", ids="")
    src = tmp_path / "xml"
    src.mkdir()
    head = '<?xml version="1.0"?>\n<!DOCTYPE PubmedArticleSet PUBLIC "x" "y">\n<PubmedArticleSet>\n'
    (src / "a.xml").write_text(head + "\n".join([art(1), art(2)[:400], art(3), art(4).replace("</Article>", "</Artcle>"), art(5)]) + "</PubmedArticleSet>")
    (src / "b.xml").write_text(art(6) + art(7) + art(8)[:200])
    (src / "c.xml").write_text("")
    (src / "d.xml").write_text("<PubmedArticleSet>\n" + art(9) + "\n</PubmedArticleSet>\n")
    side = str(tmp_path / "rejects")
    got = X.read_pubmed_xml(spark, str(src), rejects=side)
    assert sorted(r.pmid for r in got.collect()) == ["1", "3", "5", "6", "7", "9"]
    bad = spark.read.parquet(side).collect()
    assert len(bad) == 3 and all(r.reason == "malformed" and r.xml.startswith("<PubmedArticle>") for r in bad)


def test_cached_fetch_asks_only_for_what_is_missing(spark, tmp_path):
    from helixframe.operators import corpus as C
    path, asked = str(tmp_path / "cache"), []

    def fetch(missing):
        ids = sorted(r.pmid for r in missing.collect())
        asked.append(ids)
        return spark.createDataFrame([(i, f"T{i}", "", [], None, None, "J", []) for i in ids if i != "9"], X.RECORD_SCHEMA)

    hits = spark.createDataFrame([("g", 0, 1, "2"), ("g", 0, 2, "1"), ("h", 1, 1, "2"), ("h", 1, 2, "9")],
                                 "gene string, gene_ord int, hit_ord int, pmid string")
    one = C.cached_fetch(spark, hits, path, fetch)
    assert [(r.gene, r.pmid, r.title) for r in one.orderBy("gene_ord", "hit_ord").collect()] == [("g", "2", "T2"), ("g", "1", "T1"), ("h", "2", "T2")]
    more = hits.unionByName(spark.createDataFrame([("k", 2, 1, "3")], hits.schema))
    assert C.cached_fetch(spark, more, path, fetch).count() == 4
    assert asked == [["1", "2", "9"], ["3", "9"]]
    assert sorted(r.pmid for r in C.load_records(spark, path).collect()) == ["1", "2", "3"]


def test_symbol_cache_is_kept_with_its_misses(spark, tmp_path):
    from helixframe.operators import results as RS
    path, asked = str(tmp_path / "symbols"), []

    def look_up(missing):
        ids = sorted(r.gene_id for r in missing.collect())
        asked.append(ids)
        return spark.createDataFrame([(i, i.upper()) for i in ids if i != "none"], "gene_id string, symbol string")

    ask = lambda *ids: {r.gene_id: r.symbol for r in RS.update_symbols(spark, path, spark.createDataFrame([(i,) for i in ids], "gene_id string"), look_up).collect()}
    assert RS.load_symbols(spark, path).count() == 0
    assert ask("a", "none", "a") == {"a": "A", "none": None}
    assert ask("none", "b") == {"none": None, "b": "B"}                    # a known miss is not asked again
    assert asked == [["a", "none"], ["b"]] and RS.load_symbols(spark, path).count() == 3
