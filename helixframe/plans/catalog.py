"""All registered queries: name -> (spark builder, oracle SQL or None)."""

from __future__ import annotations


def registry() -> dict:
    from helixframe.plans import q_corpus, q_explore, q_expression, q_models, q_results, q_sources, q_stream, q_vectors
    out: dict = {}
    for mod in (q_expression, q_results, q_corpus, q_vectors, q_explore, q_models, q_stream, q_sources):
        for k, v in mod.Q.items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out
