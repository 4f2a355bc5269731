"""The registered queries: their columns and types, and their SQL where there is one."""

import duckdb
import pytest

from scorekit.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF_SMALL

COLUMNS = {
    "op1_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op3_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op5_decontamination": "doc_id bigint, item_id bigint",
    "op6_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_license": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op10_suffix_array": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op11_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op13_search": "item_id bigint, rank int, doc_id bigint, score bigint",
}
NOT_BY_DOCUMENT = ("op5_decontamination", "op11_collocations", "op13_search")


def test_one_query_for_each_operator():
    assert set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    kinds = dict(df.dtypes)
    for c in COLUMNS[name].split(", "):
        col, kind = c.split()
        assert kinds[col] == kind, (col, kinds[col])
    table = "pages" if name == "op2_url_filter" else "documents"
    n = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    got = df.count()
    assert got == n if name not in NOT_BY_DOCUMENT else got > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    want = sorted(map(str, cur.fetchall()))
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == want and set(df.columns) == set(cols)
