import random
import re

from stratalake.llm.queries import HOST_RULES, QUERIES
from stratalake.llm.url_filters import ALLOW, BLOCK, Automaton, HostRule, judge, unwanted


def glob_fits(glob, text):
    """A glob token by token, over the set of places in the text that it may have come to."""
    at, characters = {0}, iter(glob)
    for c in characters:
        if c == "*":
            at = set(range(min(at), len(text) + 1)) if at else at
        elif c == "?":
            at = {k + 1 for k in at if k < len(text)}
        else:
            c = next(characters, "\\") if c == "\\" else c
            at = {k + 1 for k in at if text[k : k + 1] == c}
    return len(text) in at


def test_automaton_against_plain_matching():
    rng = random.Random(6)
    for _ in range(200):
        globs = ["".join(rng.choices("ab*?é日\\", k=rng.randrange(9))) for _ in range(rng.randrange(1, 40))]
        globs = [g[:-1] if g.endswith("\\") and not g.endswith("\\\\") else g for g in globs]
        texts = ["".join(rng.choices("abé日*?\\", k=rng.randrange(12))) for _ in range(30)] + ["a" * 500, ""]
        found = Automaton(globs).fits([t.encode() for t in texts])
        assert found.tolist() == [[glob_fits(g, t) for g in globs] for t in texts], globs


def test_many_words_of_rules():
    globs = [f"*{k:05d}*" for k in range(500)]
    automaton = Automaton(globs)
    assert automaton.words > 40
    assert automaton.fits([b"x00007y00499z", b"0000"]).sum(axis=1).tolist() == [2, 0]


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    query = re.match(r"\??([^#]*)", rest[len(host) + len(path) :])[1]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path, query


def brute(url, rules=HOST_RULES, globs=None):
    host, path, query = parts(url)
    fitting = [r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    if fitting:
        rule = min(fitting, key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
        return host, path, rule.name, rule.verdict
    whole = f".{host}#{path}#{query}"
    bad = any(glob_fits(g, whole) for g in (unwanted() if globs is None else globs))
    return host, path, None, BLOCK if bad else ALLOW


URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "HTTP://A.ORG/x", "http://a.org?x=/", "http://a.org#/",
    "http://example.org/es/", "https://m.example.org/es/1?q#f", "http://xexample.org/es/", "http://example.org/es", "http://EXAMPLE.org/en/123",
    "http://a.net/example.org/es/", "http://a.net/.com/de/", "http://com/de/x", "http://www.com/fr/", "http://a.com:80/de/", "ftp://a.com/de/://b.org/",
    "http://www.casino-x.example.net/", "http://occasino.net/", "http://free-bets.example.com/en/", "http://a.net/file.ZIP", "http://a.net/file.zip?x",
    "http://ÉXAMPLE.org/é日", "http://a.com/\nde/", "http://b.net/" + "x" * 5_000 + ".exe", "http://a.net/*?*", "http://.org/", "http://a..org//",
]


def pages(spark, urls):
    rows = [(k, u, "h", "x", "x", "x") for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string, whole string")


def test_query(spark, tmp_path):
    urls = URLS + [rng_url(random.Random(k)) for k in range(300)] + URLS[:5]
    pages(spark, urls).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op11_url_filters"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == [(k, *brute(u)) for k, u in enumerate(urls)]


def rng_url(rng):
    host = ".".join(rng.choices(["www", "example", "adult", "my-pills", "com", "org", "a"], k=rng.randrange(1, 4)))
    return f"http://{host}.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['es/', 'en/1', 'en/2', 'de/', 'fr/', ''])}{rng.choice(['', 'x.exe', '?q=1'])}"


def test_equal_lengths_and_characters_of_globs(spark):
    rules = [HostRule("a.net", "/x*", ALLOW), HostRule("a.net", "/x*", BLOCK), HostRule("a.net", "/", ALLOW)]
    urls = ["http://a.net/x*1", "http://a.net/xy", "http://b.net/?evil=1"]
    got = judge(pages(spark, urls), rules, ["*#*#*evil=?"]).orderBy("page_id").collect()
    assert [(r.rule, r.verdict, r.pattern) for r in got] == [
        ("a.net/x*", BLOCK, None),
        ("a.net/", ALLOW, None),
        (None, BLOCK, "*#*#*evil=?"),
    ]


def test_no_rules_and_no_rows(spark):
    assert [r.verdict for r in judge(pages(spark, ["http://a.org/"]), [], []).collect()] == [ALLOW]
    assert judge(pages(spark, []), HOST_RULES).collect() == []
