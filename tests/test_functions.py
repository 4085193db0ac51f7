"""Column functions: fixed values, header regexes, text rules, term hashing."""

from pyspark.ml.feature import HashingTF, StopWordsRemover
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.functions import metadata as md
from quire.functions import text as tx
from tests.hashing_twin import bucket_of, murmur3_x86_32


def test_stop_words_equal_spark_default(spark):
    assert list(fv.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(fv.ENGLISH_STOP_WORDS) == 181


def test_bucket_of_matches_fixture_values():
    # values observed with HashingTF(numFeatures=2000)
    assert bucket_of("") == 1372
    assert bucket_of("ship") == 622
    assert bucket_of("sailed") == 761
    assert bucket_of("call") == 1146
    assert bucket_of("ishmael") == 1519


def test_murmur3_known_vector():
    # MurmurHash3 x86_32 reference vectors (seed 0)
    assert murmur3_x86_32(b"", 0) == 0
    assert murmur3_x86_32(b"hello", 0) == 613153351
    assert murmur3_x86_32(b"The quick brown fox jumps over the lazy dog", 0) == 776992547


def test_bucket_of_matches_hashingtf_on_many_terms(spark):
    terms = ["", "a", "ab", "abc", "abcd", "abcde", "café", "naïve", "x" * 37, "über", "日本語"]
    df = spark.createDataFrame([(i, [t]) for i, t in enumerate(terms)], "id int, w array<string>")
    out = HashingTF(inputCol="w", outputCol="v", numFeatures=2000).transform(df).collect()
    for row in out:
        assert list(row.v.indices) == [bucket_of(terms[row.id])]


def _headers(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    date = md.release_date("text")
    return df.select(
        md.raw_title().alias("title"), md.raw_author().alias("author"), date.alias("date"),
        md.raw_language().alias("language"), md.raw_encoding().alias("encoding"),
        md.year_from_date(date).alias("year_q10"), md.year_from_line().alias("year_q12"),
    ).first()


def test_header_regexes_crlf(spark):
    text = ("Title: Moby Dick\r\nAuthor: Herman Melville\r\nRelease Date: June 5, 2008 "
            "[EBook #2701]\r\nLanguage: English\r\n   \r\nCharacter set encoding: UTF-8\r\nbody")
    r = _headers(spark, text)
    assert r.title == "Moby Dick" and r.author == "Herman Melville"
    assert r.date == "June 5, 2008 "  # not trimmed
    assert r.language == "English" and r.encoding == "UTF-8"
    assert r.year_q10 == 2008 and r.year_q12 == 2008


def test_header_regex_crosses_newline_and_missing_final_newline(spark):
    r = _headers(spark, "Title: \nAuthor: Nobody\nRelease Date: [EBook #12345]\nLanguage: French")
    assert r.title == "Author: Nobody"  # \s* crosses the newline
    assert r.author == "Nobody"
    assert r.date == "[EBook #12345]"  # (.+?) takes at least one character
    assert r.language == ""  # header on the last line without newline does not match
    assert r.year_q10 == 1234 and r.year_q12 == 1234  # both rules read the EBook number


def test_year_rules_differ(spark):
    r = _headers(spark, "Release Date: June [EBook #2701]\n")
    assert r.year_q10 is None
    assert r.year_q12 == 2701


def test_unanchored_title(spark):
    assert _headers(spark, "Original Title: X\n").title == "X"


def test_file_name_from_path(spark):
    df = spark.createDataFrame([("file:/a/b/a%20b.txt",), ("hdfs://n/x/y.txt",)], "p string")
    assert [r[0] for r in df.select(md.file_name_from_path("p")).collect()] == ["a%20b.txt", "y.txt"]


def test_clean_text_rule(spark):
    df = spark.createDataFrame([("Call me Ishmael, don't. café!  X ",)], "t string")
    assert df.select(tx.clean_text("t")).first()[0] == "call me ishmael  don t  caf   x "


def test_assemble_lines_rule(spark):
    df = spark.createDataFrame([("a\r\n\r\nb\rc\n\n   \nd\n",), ("\n\n",)], "t string")
    got = [r[0] for r in df.select(tx.assemble_lines("t")).collect()]
    assert got == ["a\nb\nc\n   \nd", ""]


def test_assemble_lines_equals_split_form(spark, sf_smoke):
    from quire.sources import tables

    edge = ["", "x", "\r\rx\r\n", "a\n\u2028", " \n \n", "a\r\n\rb", "\n\r\n\rq\r",
            "a\u0085b\n"]
    docs = tables.documents(spark, sf_smoke).select(tx.inject_blank_lines("text").alias("t"))
    docs = docs.unionByName(spark.createDataFrame([(e,) for e in edge], "t string"))
    lines = F.split("t", fv.LINE_BREAK_PATTERN)
    by_split = F.array_join(F.filter(lines, lambda x: x != F.lit("")), "\n")
    assert docs.filter(tx.assemble_lines("t") != by_split).count() == 0


def test_long_runs_of_white_space_are_linear(spark):
    import time

    df = spark.createDataFrame([("a" + " " * 1_000_000 + "b\t\n \x0b\x0c\r",)], "t string")
    began = time.perf_counter()
    size = df.select(F.size(tx.tokens(tx.clean_text("t")))).first()[0]
    assert size == 1_000_001 and time.perf_counter() - began < 10


def test_java_clean_pattern_equals_rule(spark, sf_smoke):
    # the faster JVM spelling must match exactly what the stated rule matches
    from quire.sources import tables

    exotic = ["İstanbul \u212aelvin Å é É ß ẞ ǅ \u0085 \x0b\x0c x\ty\r\nz 😀 a1b2_c-d'e",
              "ABC abc XYZ xyz [\\]^_` {|}~ @ 0-9", "", "   ", "\u00a0nbsp\u2028"]
    docs = tables.documents(spark, sf_smoke).select("text").unionByName(
        spark.createDataFrame([(t,) for t in exotic], "text string"))
    a = docs.select(F.regexp_replace("text", fv.CLEAN_PATTERN, " ").alias("x"))
    b = docs.select(F.regexp_replace("text", fv.CLEAN_PATTERN_JAVA, " ").alias("x"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_strict_headers_take_no_other_line(spark):
    from quire.operators.metadata import extract_metadata

    texts = {
        1: "Title: \nAuthor: Nobody\nRelease Date: June 1, 1905 [EBook #2701]\nLanguage: English",
        2: "Original Title: Old\r\nTitle:  New book \r\nAuthor:\tA. B.\r\nRelease Date: [EBook #12345]\r\n",
        3: "no header", 4: "", 5: None, 6: "Character set encoding: UTF-8", 7: "x\nTitle: Last line",
    }
    books = spark.createDataFrame(list(texts.items()), "file_name int, text string")
    strict = {r.file_name: tuple(r)[1:] for r in extract_metadata(books, strict=True).collect()}
    none = (None, None, None, None, None)
    assert strict[1] == (None, "Nobody", 1905, "English", None, "June 1, 1905")
    assert strict[2] == ("New book", "A. B.", None, None, None, "")
    assert strict[3] == strict[4] == (*none, "") and strict[5] == (*none, None)
    assert strict[6] == (None, None, None, None, "UTF-8", "") and strict[7] == ("Last line", *none[:4], "")
    usual = {r.file_name: tuple(r)[1:] for r in extract_metadata(books).collect()}
    assert usual[1][:2] == ("Author: Nobody", "Nobody") and usual[2][0] == "Old" and usual[7][0] is None


def test_letters_of_every_script_on_request(spark):
    from quire.operators import terms, tfidf

    docs = spark.createDataFrame([(1, "Café ÉTÉ 12 naïve-ish 日本 the"), (2, None), (3, "cafe")], "doc_id int, text string")
    unicode = {r.term for r in terms.term_frequencies(docs, letters="unicode").collect()}
    assert unicode == {"café", "été", "naïve", "ish", "日本", "cafe"}
    assert {r.term for r in terms.term_frequencies(docs).collect()} == {"caf", "t", "na", "ve", "ish", "cafe"} - {"t"}
    words = {r.doc_id: r.words for r in terms.tokenize(docs, letters="unicode").collect()}
    assert "été" in words[1] and words[2] == [""]
    assert {r.term for r in tfidf.tfidf_terms(docs, letters="unicode").collect()} == unicode
