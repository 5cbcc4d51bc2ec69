from collections import Counter, defaultdict

from pyspark.sql import functions as F

from planmart.llm import linefreq


def brute(rows, ratio, least):
    pages, on = Counter(), defaultdict(Counter)
    for host, text in rows:
        pages[host] += 1
        on[host].update({x.strip(" ") for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in rows:
        if text is None:
            out.append((host, None, 0, 0))
            continue
        lines = text.split("\n")
        keep = [x for x in lines if not x.strip(" ") or on[host][x.strip(" ")] < least
                or on[host][x.strip(" ")] <= ratio * pages[host]]
        out.append((host, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def test_against_brute_force(session):
    rows = [("a", f"menu\nline {i}\nmenu\n  menu \n\nfoot {i % 4}") for i in range(20)]
    rows += [("a", "menu"), ("a", None), ("a", ""), ("b", "menu\nx"), ("b", "menu\ny"), (None, "menu\nz"), (None, "q")]
    rows += [(None, "menu")] * 6 + [("c", "long " * 50000 + "\nmenu")] * 3
    df = session.createDataFrame([(h, t, 1, 2, 3) for h, t in rows],
                                 "site string, body string, n_lines int, _kept int, _bad int")
    got = linefreq.drop_boilerplate(df, "site", "body", 0.3, 3)
    assert got.columns == ["site", "body", "_kept", "_bad", "n_lines", "n_dropped"]
    assert got.where("_kept <> 2 OR _bad <> 3").count() == 0
    assert sorted(map(str, ((r.site, r.body, r.n_lines, r.n_dropped) for r in got.collect()))) == \
        sorted(map(str, brute(rows, 0.3, 3)))
    assert linefreq.drop_boilerplate(df.limit(0), "site", "body").count() == 0


def test_small_hosts_have_the_ratio_too(session):
    rows = [("small", f"menu\npage {i}") for i in range(4)] + [("one", "menu\nalone"), ("two", "menu\nx"), ("two", "menu\ny")]
    df = session.createDataFrame(rows, "host string, text string")
    got = linefreq.drop_boilerplate(df, "host", "text")
    assert sorted((r.host, r.text) for r in got.collect()) == \
        [("one", "menu\nalone"), *(("small", f"page {i}") for i in range(4)), ("two", "x"), ("two", "y")]
    assert sorted(map(str, ((r.host, r.text, r.n_lines, r.n_dropped) for r in got.collect()))) == sorted(map(str, brute(rows, 0.1, 2)))


def test_the_plan_has_no_python_and_partial_counts(session, small_dir):
    pages = linefreq.page_lines(session.read.parquet(f"{small_dir}/pages.parquet"))
    plan = linefreq.drop_boilerplate(pages, "host", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    counted = linefreq.boilerplate(pages, "host", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in counted and counted.count("partial_count") == 2


def test_hosts_and_html(session):
    df = session.createDataFrame([("HTTP://User.Example.COM:80/x",), ("nothing",), (None,)], "url string")
    assert [r[0] for r in df.select(linefreq.url_host(F.col("url"))).collect()] == ["user.example.com", "", ""]
    html = ("<html><head><title>t</title></head><body><script>var a='</p>';</script><!-- c --><nav><li><a href='x'>A b</a>"
            "</li></nav>\n<p> one  <b>two</b><br>three</p></body></html>")
    df = session.createDataFrame([(html,), (None,), ("",)], "h string")
    assert [r[0] for r in df.select(linefreq.html_lines(F.col("h"))).collect()] == ["A b\none two\nthree", None, ""]
