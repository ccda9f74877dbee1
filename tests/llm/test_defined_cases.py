"""Stated cases: empty tables, repeated rows, clashing columns, long texts."""

from pyspark.sql import functions as F

from tessera.llm import decontaminate, language_id, quality, registry, token_counts, url_filter

SF = "/root/testdata/sf0.001"
LONG = "a quick word, " * 20_000


def test_token_counts(spark):
    pieces = token_counts.load_pieces(registry.tokenizer_file("piece_bpe_32k.model"))
    rows = [(1, "two words"), (1, "two words"), (2, LONG), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plain = token_counts.count_tokens(docs, pieces)
    clash = docs.select("*", *[F.lit("clash").alias(c) for c in plain.columns if c != "doc_id"], F.lit(1).alias("words"))
    got = [tuple(r) for r in token_counts.count_tokens(clash, pieces).orderBy("doc_id").collect()]
    assert got == [tuple(r) for r in plain.orderBy("doc_id").collect()]
    by_id = {r.doc_id: r for r in plain.collect()}
    assert got[0] == got[1] and by_id[2].n_words == 60_000 and by_id[3].n_tokens == by_id[4].n_tokens == 0
    assert token_counts.count_tokens(docs.where("false"), pieces).count() == 0


def test_quality_and_language(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(1, LONG), (1, LONG), (2, None)], "doc_id long, text string").withColumn("held_out", F.lit("clash"))
    model = quality.fit(docs, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == 3 and len({r.score for r in got if r.doc_id == 1}) == 1
    assert quality.score(odd.where("false"), model).count() == 0
    assert quality.score(odd, quality.fit(docs.where("false"), labels)).count() == 3
    known = language_id.fit(docs, learn=F.lit(True))
    assert len({(r.language.lang, r.language.score) for r in language_id.identify(odd.where("doc_id = 1"), known).collect()}) == 1


def test_repeated_and_long_urls(spark):
    urls = ["http://a.org/x/1", "http://a.org/x/1", "http://a.org/" + "s/" * 3000, None]
    pages = spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = url_filter.judge(pages).collect()
    assert sorted(r.page_id for r in got) == [0, 0, 1, 1] and {r.verdict for r in got} == {"allow"}


def test_decontamination(spark):
    phrase = " ".join(f"w{i}" for i in range(13))
    rows = [(1, f"x {phrase} y"), (1, f"x {phrase} y"), (2, LONG + phrase), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    bench = spark.createDataFrame([("q1", phrase), ("q1", phrase)], "item_id string, text string")

    def report(d, b):
        return sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated)
                      for r in decontaminate.report(decontaminate.find(d, decontaminate.phrase_blocks(b))).collect())
    assert report(docs, bench) == [(1, 15, 13, 1, True)] * 2 + [(2, 60_013, 13, 1, False), (3, 0, 0, 0, False)]
    assert report(docs.where("false"), bench) == []
    assert report(docs, bench.where("false")) == [(1, 15, 0, 0, False)] * 2 + [(2, 60_013, 0, 0, False), (3, 0, 0, 0, False)]
