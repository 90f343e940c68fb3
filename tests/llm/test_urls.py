import random
import re

from civiclake.llm import urls
from conftest import rows


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    best = None
    for what, rule in urls.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[1]):
                best = (what, rule)
    return best


def brute(pages):
    hosts, links = {}, {}
    for _, url, html in pages:
        host, path = parts(url)
        rule = rule_of(host, path)
        seen = hosts.setdefault(host, [0, 0, 0])
        seen[2] += 1
        if rule:
            seen[0 if rule[0] == "allow" else 1] += 1
        for link in set(re.findall(r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)""", html or "")):
            other = parts("http:" + link if link.startswith("//") else link)[0]
            if host and other and host != other:
                links[host, other] = links.get((host, other), 0) + 1
    for _, other in links:
        hosts.setdefault(other, [0, 0, 1])
    result = {}
    for way, (a, b) in enumerate([(0, 1), (1, 0)]):
        total = {}
        for edge, n in links.items():
            total[edge[a]] = total.get(edge[a], 0) + n
        own = {h: 0.15 * seen[way] / seen[2] for h, seen in hosts.items()}
        score = dict(own)
        for _ in range(urls.ROUNDS):
            new = dict(own)
            for edge, n in links.items():
                new[edge[b]] += 0.85 * score[edge[a]] * n / total[edge[a]]
            score = new
        result[way] = score
    out = []
    for key, url, _ in pages:
        host, path = parts(url)
        rule = rule_of(host, path)
        bad = result[1][host] - result[0][host] >= urls.THRESHOLD
        out.append((key, host, path, rule[1] if rule else None, rule[0] if rule else "block" if bad else "allow"))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    hosts = [f"h{i}.example.{t}" for i in range(6) for t in ("com", "org", "net")] + ["other.com", "NET", "Org", "a.b.co"]
    paths = ["", "/", "/en/1", "/de/x?y=/fr/", "/fr/2#t", "/FR/", "?q=/en/", "#/de/", "/en", "/de/" + "z" * 3000]
    pages = []
    for n in range(300):
        url = f"{rng.choice(['http', 'HTTPS', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}"
        links = [f'<a href="{rng.choice(["http:", "https:", ""])}//{rng.choice(hosts)}/p">' for _ in range(rng.randint(0, 4))]
        pages.append((n, url, "<p>" + "x".join(links) + "<a href='/rel'>" + ' HREF=http://bare.org/1 ' * (n % 7 == 0)))
    return pages + [(1000, None, None), (1001, "no scheme", ""), (None, "http://u@x.net:80/", "<a href="), pages[0], (1002, "", "//")]


def test_against_brute_force(spark):
    pages = fixture()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS weight", "3 AS trust")
    assert rows(urls.filter_urls(df)) == brute(pages)


def test_without_links_and_empty(spark):
    pages = [(n, url, "<p>") for n, url, _ in fixture()]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert rows(urls.filter_urls(df)) == brute(pages)
    assert urls.filter_urls(df.limit(0)).isEmpty()


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(fixture(), "page_id long, url string, html string")
    plan = urls.filter_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
