from dugout.sources import games, pages


def page(spark, url, html):
    return spark.createDataFrame([(1, url, html)], "id int, url string, html string")


def test_links(spark, rows):
    html = '<a href="/x">a</a><a class="c" href="gid_1/">b</a><a href="http://o.org/">c</a><a href="#t">d</a><a href="//h/p">e</a>'
    got = rows(pages.links(page(spark, "http://s.com/dir/page?q=1", html), "id", "url", "html"), "pos", "resolved")
    assert got == [
        (0, "http://s.com/x"), (1, "http://s.com/dir/gid_1/"), (2, "http://o.org/"), (3, "http://s.com/dir/page?q=1#t"), (4, "http://h/p"),
    ]
    assert rows(pages.links(page(spark, "http://s.com", html), "id", "url", "html", "gid"), "resolved") == [("http://s.com/gid_1/",)]


def test_manifest_links(spark, rows):
    df = spark.createDataFrame([("http://s/gid_1/",)], "g string")
    got = rows(pages.game_file_links(df, "g", games.MANIFEST), "file_address")
    assert len(got) == 6 and ("http://s/gid_1/inning/inning_all.xml",) in got


def test_inclusive_range(spark, rows):
    names = ["u/2014/", "u/2015/", "u/2015/05/", "u/2016/", "u/2017/"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, a string")
    assert rows(pages.inclusive_range(df, "i", "a", "u/2015/", "u/2016/07/"), "i") == [(1,), (2,), (3,)]
    assert rows(pages.inclusive_range(df, "i", "a", "u/2015/03/", "none"), "i") == [(1,), (2,), (3,), (4,)]
    assert pages.inclusive_range(df, "i", "a", "zzz", "u/2016/").count() == 0


def test_roster_page(spark, rows):
    html = (
        '<table><tr class="stathead"><td colspan="3">Pitchers</td></tr><tr class="oddrow player-1"><td>7</td><td><a href="p">Ann Example</a></td><td>SP</td></tr>'
        '<tr class="stathead"><td>Disabled List</td></tr><tr class="evenrow player-2"><td>8</td><td><a href="p">Bo Other</a></td><td>DH</td></tr>'
        '<tr class="stathead"><td>Coaches</td></tr><tr class="oddrow player-3"><td>9</td><td><a>Cy Third</a></td><td>C</td></tr></table>'
    )
    got = rows(pages.roster_rows(page(spark, "u", html), "id", "html"), "section", "number", "name", "position", "active")
    assert got == [
        ("Coaches", "9", "Cy Third", "C", "Unknown"), ("Disabled List", "8", "Bo Other", "DH", "Inactive"), ("Pitchers", "7", "Ann Example", "SP", "Active"),
    ]
