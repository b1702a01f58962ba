"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (bpe, codes, importance, inner_search, langid, licenses, lm, metric_join, ngram_join,
               packing, quality, secrets, urls)

QUERIES = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_url_filter": urls.op4_url_filter,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_lm_score": lm.op6_lm_score,
    "op7_language": langid.op7_language,
    "op8_pack": packing.op8_pack,
    "op9_quality": quality.op9_quality,
    "op10_metric_join": metric_join.op10_metric_join,
    "op11_top_products": inner_search.op11_top_products,
    "op12_importance_resample": importance.op12_importance_resample,
    "op13_vector_codes": codes.op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {**licenses.ORACLE_SQL, **urls.ORACLE_SQL, **quality.ORACLE_SQL,
              **inner_search.ORACLE_SQL,
              **importance.ORACLE_SQL, **codes.ORACLE_SQL}
