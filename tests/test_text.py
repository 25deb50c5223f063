import unicodedata

from pyspark.sql import functions as F

from siftwell.functions import masking
from siftwell.functions import text as T
from siftwell.functions.murmur import murmur3
from siftwell.sources import html


def run(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_lines_split_like_python(spark):
    texts = ["", "a\nb\n", "a\r\nb\rc\x0bd\x85e f", "\n\n", "x", None]
    assert run(spark, T.lines(F.col("text")), *texts) == [t.splitlines() if t is not None else None for t in texts]


def test_normalize_whitespace(spark):
    texts = ["  a \n\n\t\xa0b　\r\n ", "", " \n ", None]
    expected = ["\n".join(x.strip() for x in t.splitlines() if x.strip()) if t is not None else None for t in texts]
    assert run(spark, T.normalize_whitespace(F.col("text")), *texts) == expected


def test_grams_keep_words_at_line_ends_apart(spark):
    assert run(spark, T.normalize_for_grams(F.col("text")), "Foo bar\nbaz", "Ça, là-bas!") == ["foo bar baz", "ca labas"]
    assert run(spark, T.normalize_for_grams(F.col("text"), literal=True), "Foo bar\nbaz") == ["foo barbaz"]


def test_ngrams(spark):
    assert run(spark, T.ngrams(F.col("text"), 2), "a b a b", "a", "", None) == [["a b", "b a"], [], [], []]


def test_unaccent_equals_decomposition():
    for src, dst in zip(T.ACCENTED, T.PLAIN):
        assert "".join(c for c in unicodedata.normalize("NFD", src) if unicodedata.category(c) != "Mn") == dst


def test_masks_see_what_is_left(spark):
    masked, counts = masking.mask(F.col("text"))
    texts = ["mail a.b@c.example now", "call (743) 555-3824", "at 10.0.0.1, yes", "10.0.0.1 555-1234", "1.2.3.4567", "", None]
    assert run(spark, masked, *texts) == ["mail |||EMAIL_ADDRESS||| now", "call |||PHONE_NUMBER|||", "at |||IP_ADDRESS|||, yes", "10.0.0.|||PHONE_NUMBER|||", "|||IP_ADDRESS|||67", "", None]
    assert run(spark, counts["email"], "a@b.cc x@y.zz", None) == [2, None]


def test_mask_of_mail_is_idempotent(spark):
    once = run(spark, masking.mask_one(F.col("text"), "email")[0], "to a@b.example")
    assert run(spark, masking.mask_one(F.col("text"), "email")[0], *once) == once


def test_murmur_published_value():
    assert murmur3(b"foo", 0) == 4138058784
    assert murmur3(b"", 0) == 0


def test_html():
    page = "<html><head><title>t</title></head><body><nav>menu</nav><h1>Head  line</h1><p>One <a href='x'>link</a> in\n a row<p>Two &amp; more<ul><li>item</ul><footer>foot</footer><script>var x='</p>'</script></body></html>"
    assert html.extract(page) == "Head line\n\nOne link in a row\n\nTwo & more\n\n  • item"
    assert "menu" in html.extract(page, main_content=False)
    assert html.extract(None) == html.extract("") == ""
    assert html.extract("<p>é</p>".encode("cp1252")) == "é"
