"""Every operator carries columns of any name and type."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rookery.llm import languages, licenses, lexical, mixing, neighbours, pieces, quality_model, quality_rules, simhash
from rookery.llm import suffix_dedup, topk, whitening

TEXT = " ".join(f"word{i} and the other" for i in range(30))


def public(name):
    import public_tokenizers

    return public_tokenizers.path(name)


@pytest.fixture
def docs(make_docs):
    more = ["1 AS `a b`", "'x' AS `a.b`", "array(1) AS `a-b`", "struct(2 AS `c d`) AS `e``f`", "3 AS row", "4 AS text2"]
    return make_docs([(i, TEXT[i * 7 :], "en", "s") for i in range(5)] + [(9, None, None, None)]).selectExpr("*", *more)


CASES = {
    "mix_copies": lambda d: mixing.mix_copies(d),
    "scan_licenses": lambda d: licenses.scan_licenses(d),
    "text_features": lambda d: quality_model.text_features(d, tuple(d.columns)),
    "remove_repeats": lambda d: suffix_dedup.remove_repeats(d),
    "encode_pieces": lambda d: pieces.encode_pieces(d, public("piece_bpe_32k.model")),
    "identify_languages": lambda d: languages.identify_languages(d, languages.train_languages(d)),
    "near_duplicates": lambda d: simhash.near_duplicates(d),
    "quality_rules": lambda d: quality_rules.quality_rules(d),
}


@pytest.mark.parametrize("name", list(CASES))
def test_row_holds_all_columns(docs, name):
    found = CASES[name](docs)
    want = [c for c in docs.columns if c != "text" or name != "remove_repeats"]
    assert found.select("row.*").columns == want
    rows = found.select("row.*").collect()
    assert len(rows) == 6 and {(r["a b"], r["a.b"], tuple(r["a-b"]), r["e`f"]["c d"]) for r in rows} == {(1, "x", (1,), 2)}


def test_rows_pass_through_whole(docs):
    assert sorted(simhash.one_of_each(docs).columns) == sorted(docs.columns)
    assert sorted(mixing.mix(docs).columns) == sorted(docs.columns)


def test_named_columns_of_any_name(docs, spark):
    odd = docs.withColumnsRenamed({"text": "the.text", "lang": "a lang", "doc_id": "doc-id", "source": "s.o"})
    names = {"text_column": "the.text"}
    assert licenses.scan_licenses(odd, **names).count() == 6
    assert simhash.near_duplicates(odd, id_column="doc-id", **names).count() == 6
    assert suffix_dedup.remove_repeats(odd, id_column="doc-id", **names).count() == 6
    assert mixing.mix_copies(odd, id_column="doc-id", source_column="s.o", **names).count() == 6
    assert quality_rules.quality_rules(odd, lang_column="a lang", **names).count() == 6
    model = languages.train_languages(odd, lang_column="a lang", **names)
    assert languages.identify_languages(odd, model, **names).count() == 6
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "`vec.id` long, `an embedding` array<float>")
    args = {"id_column": "vec.id", "vector_column": "an embedding"}
    assert whitening.whiten(vectors, **args).count() == 10
    assert neighbours.nearest_neighbours(vectors, F.col("`vec.id`") == 0, k=2, **args).count() == 2
    assert topk.top_inner_products(vectors, F.col("`vec.id`") == 0, k=2, **args).count() == 2
    items = spark.createDataFrame([(1, "word1 the")], "`item.id` long, `item text` string")
    args = {"id_column": "doc-id", "item_column": "item.id", "item_text_column": "item text", **names}
    assert lexical.rank_documents(odd, items, **args).count() == 5
