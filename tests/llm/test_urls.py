import hashlib
import math
import re
from collections import Counter, defaultdict

from helpers import rows, table
from pyspark.sql import functions as F

from ledgerspark.llm import urls


def host_and_path(url):
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match("[^/?#]*([^?#]*)", rest)[1]


def rule(host, path):
    best = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(best)[1:] if best else (None, None)


def grams(url):
    padded = "^" * urls.ORDER + (url or "")
    return [padded[i : i + urls.ORDER + 1] for i in range(len(url or ""))]


def set_aside(url):
    return url is not None and hashlib.md5(url.encode()).hexdigest() < "3"


class Model:
    """Witten-Bell by dictionaries: for each context, how often each sign followed it."""

    def __init__(self, labelled, signs):
        self.after, self.signs = defaultdict(Counter), signs
        for url in labelled:
            for gram in grams(url):
                for k in range(urls.ORDER + 1):
                    self.after[gram[-k - 1 : -1]][gram[-1]] += 1

    def likely(self, gram):
        p = 1 / (self.signs + 1)
        for k in range(urls.ORDER + 1):
            seen = self.after.get(gram[-k - 1 : -1])
            if seen:
                p = (seen[gram[-1]] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p


def brute(data):
    """The same decisions with dictionaries."""
    judged = [(key, url, *host_and_path(url), *rule(*host_and_path(url))) for key, url in data]
    signs = len({c for _, url in data for c in url or ""})
    models = {(v, part): Model([u for _, u, _, _, _, verdict in judged if verdict == v and not (part and set_aside(u))], signs) for v in ("allow", "block") for part in (False, True)}

    def level(url, part):
        found = grams(url)
        ratio = sum(round((math.log(models["allow", part].likely(g)) - math.log(models["block", part].likely(g))) * 1e6) for g in found)
        return math.floor(ratio / len(found) / 10_000) if found else 0

    aside = [(level(url, True), verdict) for _, url, _, _, _, verdict in judged if verdict and set_aside(url)]
    size = Counter(v for _, v in aside)
    least = 0
    if len(size) == 2:
        # every cut up to the highest bin that occurs
        every = range(min(b for b, _ in aside + [(0, "")]), max(b for b, _ in aside) + 1)
        wrong = [(sum(b < t and v == "allow" for b, v in aside) / size["allow"] + (1 - sum(b < t and v == "block" for b, v in aside) / size["block"]), abs(t), t) for t in every]
        least = min(wrong)[2]
    return sorted([(key, host, path, r, v or ("allow" if level(url, False) >= least else "block")) for key, url, host, path, r, v in judged], key=repr)


def test_given_pages(spark, small, medium):
    for folder in (small, medium):
        assert rows(urls.op4_url_filter(spark, folder)) == brute(table(folder, "pages")[["page_id", "url"]].values.tolist())


def test_odd_urls(spark):
    data = [(1, None), (2, ""), (3, "http://A.ORG"), (4, "http://a.org/"), (None, "x"), (5, "http://EXAMPLE.org/en/1?x"), (6, "http://日本.com/fr/" + "ü" * 5000), (7, "a://b?://c/"),
            (8, "http://com/de/"), (8, "http://com/de/"), (9, "http://notcom/de/"), (10, "http://x.example.org/es/y"), (11, "http://example.org/en/2")]
    df = spark.createDataFrame(data, "page_id long, url string").selectExpr("*", "'q' as host", "1 as bin", "2 as model", "3 as verdict")
    got = rows(urls.judge(df).drop("margin"))
    assert got == brute(data)
    assert urls.judge(df.limit(0)).count() == 0


def labelled(n):
    """Pages that the rules decide, with the number 1 behind /en/ in rejected ones and others in accepted ones."""
    hosts = [f"h{k}" for k in range(40)]
    return [(k, f"http://{hosts[k % 40]}.example.org/en/{'1' if k % 2 else '2'}{k}") for k in range(n)]


def test_digits_and_letters_of_any_script_are_told_apart(spark):
    new = [(9001, "http://x.net/en/1"), (9002, "http://x.net/en/2")]
    data = labelled(400) + new
    got = {r[0]: r[4] for r in rows(urls.judge(spark.createDataFrame(data, "page_id long, url string")).drop("margin"))}
    assert (got[9001], got[9002]) == ("block", "allow")
    words = {True: "日本語", False: "中文字"}
    data = [(k, f"http://{'example' if k % 2 else 'another'}.org/es/{words[k % 2 == 1]}{k}") for k in range(400)] + [(9001, "http://b.net/es/日本語"), (9002, "http://b.net/es/中文字")]
    got = rows(urls.judge(spark.createDataFrame(data, "page_id long, url string")).drop("margin"))
    assert got == brute(data) and {r[0]: r[4] for r in got if r[0] > 9000} == {9001: "block", 9002: "allow"}


def test_ids_do_not_matter_and_the_table_grows(spark):
    data = labelled(200) + [(900 + k, f"http://c{k}.net/en/{k}") for k in range(20)]
    plain, tenfold = (rows(urls.judge(spark.createDataFrame([(i * f, u) for i, u in data], "page_id long, url string")).drop("margin")) for f in (1, 10))
    assert sorted((r[0] * 10, *r[1:]) for r in plain) == sorted(tenfold)
    sizes = []
    for n in (50, 200):
        found = spark.createDataFrame(labelled(n), "page_id long, url string").selectExpr("'allow' AS verdict", "false AS aside", "url").select("verdict", "aside", F.explode(urls.grams(F.col("url"))).alias("gram"))
        sizes.append(urls.fit(urls.count(found)).count())
    assert sizes[1] > 1.5 * sizes[0]


def test_rare_grams_count_as_well(spark, monkeypatch):
    """With hardly any gram in the broadcast table the others go through the shuffle, with the same verdicts."""
    data = labelled(120) + [(900 + k, f"http://c{k}.net/fr/{k}") for k in range(10)]
    df = spark.createDataFrame(data, "page_id long, url string")
    want = rows(urls.judge(df))
    monkeypatch.setattr(urls, "FREQUENT", 3)
    assert rows(urls.judge(df)) == want


def test_no_python_in_the_plan(spark, small):
    plan = urls.op4_url_filter(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
