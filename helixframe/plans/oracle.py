"""SQL twins of the adapters, for the DuckDB correctness oracle.

``cte("counts_long", "samples")`` returns a ``WITH`` clause holding the
named views and everything they depend on, in dependency order. Queries
append their own CTEs / SELECT after it.
"""

from __future__ import annotations

# name -> (dependencies, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "cells": ((), """
  SELECT l.l_partkey, n.n_regionkey, l.l_returnflag, SUM(l.l_quantity) AS qty
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3"""),
    "counts_long": (("cells",), """
  SELECT 'ENSG' || lpad(CAST(p.p_partkey AS VARCHAR), 11, '0') || '.' || CAST(p.p_size AS VARCHAR) AS gene_id,
         'P' || lpad(CAST(x.n_regionkey AS VARCHAR), 2, '0') || '_' || x.l_returnflag AS sample_id,
         CAST(x.qty AS BIGINT) AS count
  FROM cells x JOIN part p ON x.l_partkey = p.p_partkey"""),
    "coverage_long": (("cells",), """
  SELECT 'ENSG' || lpad(CAST(p.p_partkey AS VARCHAR), 11, '0') || '.' || CAST(p.p_size AS VARCHAR) AS gene_id,
         'P' || lpad(CAST(x.n_regionkey AS VARCHAR), 2, '0') || '_' || x.l_returnflag AS sample_id,
         x.qty * 76.0 AS coverage
  FROM cells x JOIN part p ON x.l_partkey = p.p_partkey"""),
    "sample_keys": (("cells",), """
  SELECT DISTINCT n_regionkey, l_returnflag FROM cells"""),
    "study_metadata": (("sample_keys",), """
  SELECT 'P' || lpad(CAST(s.n_regionkey AS VARCHAR), 2, '0') || '_' || s.l_returnflag AS external_id,
         'tissue;;' || CASE s.l_returnflag WHEN 'A' THEN 'Primary Tumor' WHEN 'N' THEN 'Normal Mucosa'
                               WHEN 'R' THEN 'Liver metastasis' ELSE 'blood' END
           || '|patient id;; ' || CAST(s.n_regionkey AS VARCHAR) || ' |junk field|lot;;' || r.r_name
           || ';;x|lot;;' || s.l_returnflag AS sample_attributes,
         'AMC_' || lpad(CAST(s.n_regionkey AS VARCHAR), 2, '0') || '-' || s.l_returnflag || ' RNA-seq' AS experiment_title,
         s.n_regionkey AS region
  FROM sample_keys s JOIN region r ON s.n_regionkey = r.r_regionkey"""),
    "samples": (("study_metadata",), """
  SELECT sample_id, sample_idx, patient,
         CASE WHEN tissue IS NULL THEN NULL
              WHEN contains(lower(tissue), 'metasta') THEN 'metastasis'
              WHEN contains(lower(tissue), 'normal') THEN 'normal'
              WHEN contains(lower(tissue), 'tumor') OR contains(lower(tissue), 'cancer')
                   OR contains(lower(tissue), 'primary') THEN 'tumor'
              ELSE 'unknown' END AS condition
  FROM (SELECT external_id AS sample_id,
               CAST(dense_rank() OVER (ORDER BY external_id) - 1 AS INTEGER) AS sample_idx,
               'P' || regexp_extract(experiment_title, 'AMC_(\\d+)', 1) AS patient,
               trim(split_part(split_part(sample_attributes, '|', 1), ';;', 2)) AS tissue
        FROM study_metadata)"""),
    "qc": (("sample_keys",), """
  SELECT 'P' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || '_' || l_returnflag AS external_id,
         CAST(50.5 + n_regionkey * 2 AS DOUBLE) AS avg_len
  FROM sample_keys"""),
    "symbol_hits": ((), """
  SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') AS gene_id,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR) END AS symbol,
         1 AS hit_ord, p_size AS size
  FROM part
  UNION ALL
  SELECT 'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0'), replace(p_brand, '#', ''), 2, p_size
  FROM part WHERE p_size > 40"""),
    "symbol_map": (("symbol_hits",), """
  SELECT gene_id, symbol, size FROM symbol_hits WHERE hit_ord = 1"""),
    "gene_sets": ((), """
  SELECT 'TYPE_' || p_type AS term, upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR) AS symbol
  FROM part WHERE p_partkey % 7 <> 0
  UNION ALL
  SELECT 'SIZE_' || lpad(CAST(CAST(trunc(p_size / 10) AS INTEGER) AS VARCHAR), 2, '0'),
         upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR)
  FROM part WHERE p_partkey % 7 <> 0"""),
    "de_raw": ((), """
  SELECT m.contrast,
         'ENSG' || lpad(CAST(p_partkey AS VARCHAR), 11, '0') || '.' || CAST(p_size AS VARCHAR) AS gene_id,
         p_retailprice AS base_mean,
         CASE WHEN p_size = 1 THEN NULL ELSE CAST((p_partkey * 37) % 81 - 40 AS DOUBLE) / 10.0 END + m.shift AS log2_fold_change,
         0.1 + CAST(p_partkey % 10 AS DOUBLE) / 10.0 AS lfc_se,
         (CASE WHEN p_size = 1 THEN NULL ELSE CAST((p_partkey * 37) % 81 - 40 AS DOUBLE) / 10.0 END + m.shift)
           / (0.1 + CAST(p_partkey % 10 AS DOUBLE) / 10.0) AS stat,
         CASE WHEN p_size = 2 THEN NULL ELSE
           (CAST((p_partkey * m.mult) % m.md AS DOUBLE) / CAST(m.md AS DOUBLE))
           * (CAST((p_partkey * m.mult) % m.md AS DOUBLE) / CAST(m.md AS DOUBLE))
           * (CAST((p_partkey * m.mult) % m.md AS DOUBLE) / CAST(m.md AS DOUBLE)) END AS pvalue,
         p_partkey AS k
  FROM part, (VALUES ('single', 7919, 997, 0.0), ('blocked', 6007, 991, 0.5)) AS m(contrast, mult, md, shift)"""),
    "de_results": (("de_raw", "symbol_map"), """
  SELECT d.contrast, d.gene_id, d.base_mean, d.log2_fold_change, d.lfc_se, d.stat, d.pvalue,
         CASE WHEN d.pvalue IS NULL THEN NULL WHEN d.k % 50 = 7 THEN 0.05 ELSE least(1.0, d.pvalue * 3.0) END AS padj,
         s.symbol
  FROM de_raw d LEFT JOIN symbol_map s ON split_part(d.gene_id, '.', 1) = s.gene_id"""),
    "doc_parts": ((), """
  SELECT doc_id, lang, source, split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract
  FROM documents"""),
    "corpus": (("doc_parts",), """
  SELECT CAST(doc_id AS VARCHAR) AS pmid, title, abstract,
         list_filter([ 'L' || lang || ' AB',
                       CASE WHEN doc_id % 3 = 0 THEN 'S' || source ELSE 'S' || source || ' C' END,
                       CASE WHEN doc_id % 5 = 0 THEN source || ' Consortium' END,
                       CASE WHEN doc_id % 7 = 0 THEN 'Doe J' END ], lambda x: x IS NOT NULL) AS authors,
         CAST(CASE WHEN doc_id % 10 <> 0 THEN 1990 + doc_id % 30 WHEN doc_id % 20 = 0 THEN 2024 END AS INTEGER) AS year,
         CASE WHEN doc_id % 4 <> 0 THEN '10.5555/d.' || CAST(doc_id AS VARCHAR) END AS doi,
         'Journal of ' || source AS journal,
         list_filter([ CASE WHEN lang = 'en' THEN 'Colorectal Neoplasms' END,
                       'Language ' || upper(lang),
                       CASE WHEN doc_id % 3 = 0 THEN 'Humans' END ], lambda x: x IS NOT NULL) AS mesh_major_topics
  FROM doc_parts"""),
    "search_terms": ((), """
  SELECT gene, min(ord) AS gene_ord FROM (
    SELECT regexp_extract(lower(text), '^([\\p{L}\\p{N}]+)', 1) AS gene, item_id * 2 AS ord FROM benchmark
    UNION ALL SELECT regexp_extract(lower(text), '^([\\p{L}\\p{N}]+ [\\p{L}\\p{N}]+)', 1), item_id * 2 + 1 FROM benchmark)
  WHERE length(gene) > 0 GROUP BY gene"""),
    "phrases": ((), """
  SELECT gene, min(item_id) AS gene_ord FROM (
    SELECT item_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'),
                                                lambda t: length(t) > 0), ' ') AS gene FROM benchmark)
  WHERE length(gene) > 0 GROUP BY gene"""),
    "hits": (("corpus", "search_terms"), """
  SELECT gene, gene_ord, CAST(hit_ord AS INTEGER) AS hit_ord, pmid FROM (
    SELECT s.gene, s.gene_ord, d.pmid,
           row_number() OVER (PARTITION BY s.gene ORDER BY d.year DESC NULLS LAST, d.pmid DESC) AS hit_ord
    FROM (SELECT pmid, year,
                 ' ' || array_to_string(list_filter(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'),
                                                    lambda t: length(t) > 0), ' ') || ' ' AS in_title,
                 ' ' || array_to_string(list_filter(regexp_split_to_array(lower(abstract), '[^\\p{L}\\p{N}]+'),
                                                    lambda t: length(t) > 0), ' ') || ' ' AS in_abstract
          FROM corpus WHERE list_contains(mesh_major_topics, 'Colorectal Neoplasms') AND length(abstract) > 0) d
    JOIN search_terms s ON contains(d.in_title, ' ' || s.gene || ' ') OR contains(d.in_abstract, ' ' || s.gene || ' ')) WHERE hit_ord <= 20"""),
    "flat": (("hits", "corpus"), """
  SELECT h.gene, h.gene_ord, h.hit_ord, c.* FROM hits h JOIN corpus c USING (pmid)"""),
    "vectors": ((), """
  SELECT CAST(vec_id AS VARCHAR) AS id, 'G' || CAST(label AS VARCHAR) AS gene, embedding FROM embeddings"""),
}


def cte(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding ``names`` and their dependencies (plus optional extra CTE text)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({_CTES[n][1]}\n)" for n in order]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n"
