"""Goldens of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from feedloom.functions import text, time, url


def one(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


FEED = {
    "https://journal.test/notes/spark-tips?utm_medium=mail&utm_term=x": "journal.test/notes/spark-tips",
    "https://www.journal.test/notes/spark-tips/?utm_content=july": "journal.test/notes/spark-tips",
    "http://journal.test/go?page=3&ref=feed": "journal.test/go?page=3",
    "HTTP://Journal.TEST/Mixed?z=1&y=2&y=1": "journal.test/Mixed?y=1&y=2&z=1",
    "journal.test/plain": "journal.test/plain",
    "https://journal.test:8181/p/": "journal.test:8181/p",
    "https://journal.test/p#part-2": "journal.test/p",
    "": "",
    None: "",
    "https://mobile.journal.test/p": "journal.test/p",
    "https://WEB.journal.test/p": "journal.test/p",
    "https://x.com/someone": "twitter.com/someone",
    "https://twitter.com/someone/": "twitter.com/someone",
    "https://me:secret@journal.test/p?k=&l=%20m": "journal.test/p?k=&l=+m",
    "https://journal.test/p?q=%qq&bare": "journal.test/p?bare=&q=%25qq",
}
STORE = {
    "https://lab.test/papers/index/7/?utm_source=letter": "https://lab.test/papers/index/7",
    "notes.lab.test/deep/": "https://notes.lab.test/deep",
    "http://WWW.Lab.Test:8080/p?d=4&c=3&e=&from=q#top": "https://lab.test/p?d=4&c=3",
    "https://m.lab.test": "https://m.lab.test/",
    "": "",
    None: "",
    "https://lab.test/?k=5;l=6&m=%7En*": "https://lab.test/?k=5%3Bl%3D6&m=~n%2A",
}


def test_url_keys(spark):
    assert one(spark, FEED, url.feed_key) == list(FEED.values())
    assert one(spark, STORE, url.store_key) == list(STORE.values())
    again = [v for v in STORE.values() if v]
    assert one(spark, again, url.store_key) == again


def test_hosts_and_links(spark):
    assert one(spark, ["https://www.Lab.test/a", "amp.lab.test", "", "https://np.reddit.com/r", "https://lab.test:81/"], url.host_of) == ["lab.test", "lab.test", "", "reddit.com", "lab.test"]
    base = F.lit("https://lab.test/dir/page")
    got = one(spark, ["javascript:x", "//cdn.x/a", "/root", "next", "http://y/z", "", None], lambda c: url.absolute(c, base))
    assert got == ["", "https://cdn.x/a", "https://lab.test/root", "https://lab.test/dir/next", "http://y/z", "", ""]
    got = one(spark, ["a [x](https://a.b/c). https://a.b/c, <http://d>!", "none", None, "https://e/f\\)"], url.extract_urls)
    assert got == [["https://a.b/c", "http://d"], [], [], ["https://e/f"]]


S = 1_700_000_000


@pytest.mark.parametrize("offset,want", [(8, "2023-11-15 06:13"), (0, "2023-11-14 22:13"), (5.5, "2023-11-15 03:43"), (-3, "2023-11-14 19:13")])
def test_time_offsets(spark, offset, want):
    forms = [str(S), f"{S}000", f"{S}000000", f"{S}000000000", "2023-11-14T22:13:20Z", "2023-11-15T01:13:20+03:00", "2023-11-14T22:13:20"]
    assert one(spark, forms, lambda c: time.format_local(c, offset)) == [want] * len(forms)


def test_times(spark):
    bad = [None, "\t", "soon", "12h ago", "false", "[1]", '{"t": 1}', "9" * 20]
    assert one(spark, bad, lambda c: time.format_local(c)) == [""] * len(bad)
    assert one(spark, [str(S), "2023-11-14"], time.format_utc) == ["2023-11-14T22:13:20Z", "2023-11-14T00:00:00Z"]
    assert one(spark, [str(S)], lambda c: time.format_local(c, 0, "%d/%m at %H")) == ["14/11 at 22"]
    with pytest.raises(ValueError):
        time.java_pattern("%Q")


def test_texts(spark):
    assert one(spark, [" a 　 b\n", None], text.collapse) == ["a b", ""]
    assert one(spark, ["<p>x&amp;lt;y</p>&nbsp;&#39;"], text.clean_markup) == ["x<y '"]
    assert one(spark, ["The GPT-5.1 of open/source a x2 机器的学习"], text.tokens) == [["gpt-5.1", "open/source", "x2", "机", "器", "学", "习", "机器", "器的", "的学", "学习"]]
    wrapped = ["<think>no</think>\n```markdown\n# t\n[a](https://x/y\\)\n```", "plain", None, "<!-- c -->k"]
    assert one(spark, wrapped, text.strip_wrappers) == ["# t\n[a](https://x/y)", "plain", "", "k"]
    assert one(spark, ["今日头条 重要进展 https://a/b", "今日头条 重要进展", "今日头条 https://a/b"], text.looks_like_report) == [True, False, False]
    assert one(spark, ["  <!DOCTYPE html>", "<html>", "<rss>", None], text.looks_like_html) == [True, True, False, False]
    assert one(spark, ['["a","b"]', "x", " "], text.as_list) == [["a", "b"], ["x"], []]
    got = spark.sql("select 1 a, 3 b union all select 0, 0").select(text.ratio_text(F.col("a"), F.col("b")).alias("r")).collect()
    assert sorted(r.r for r in got) == ["33.3%", "—"]
    got = spark.sql("select explode(array(0, null, 9, -2, 4)) w").select(text.importance(F.col("w")).alias("i")).collect()
    assert [r.i for r in got] == [3, 3, 5, 1, 4]
