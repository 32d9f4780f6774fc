from pyspark.sql import functions as F

from leafline.functions import dates as D
from leafline.functions import html as H
from leafline.operators import lookup as L
from leafline.operators import pages as P
from leafline.plans import crawl as C

DETAIL = """<div id="content"><div class="comicinfo"><div class="thumb"><a href="#"><img alt="" src="/img/1.jpg"></a></div>
<div class="detail"><h2><span class="title">귀여운 &amp; 제목</span> <span class="wrt_nm">
 작가A / 작가B </span></h2><p>첫 줄<br>둘째 줄</p><p class="detail_info"><span class="genre">일상, 개그</span>{age}</p></div></div>
<table><tr><td class="title"><a href="/detail?titleId=7&no=52&weekday=mon">52</a></td></tr>
<tr><td class="title"><a href="/detail?titleId=7&no=51&weekday=mon">51</a></td></tr></table>
<span class="u_cbox_contents" data-x="1">좋아요
정말</span><span class="u_cbox_contents">둘 <b>째</b></span></div>"""
LISTING = """<div class="col"><ul><li><a href="/list?titleId=7&weekday=mon">귀여운 & 제목</a></li></ul></div>
<div class="col"><ul><li><a href="/list?titleId=7&weekday=tue">귀여운 & 제목</a></li>
<li><a href="/list?titleId=8&weekday=tue">다른 것</a></li><li><a href="/list?titleId=7&day=x">귀여운 & 제목</a></li></ul></div>"""


def pages(spark):
    rows = [
        (1, "/list?titleId=7", DETAIL.format(age='<span class="age">12세 이용가</span>')),
        (2, "/list?titleId=8", DETAIL.format(age="")),
        (3, "/empty", "<html></html>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def listing(spark):
    return spark.createDataFrame([(0, "/", LISTING)], "page_id long, url string, html string")


def test_detail_records(spark):
    got = {r.page_id: r for r in C.detail_records(pages(spark)).collect()}
    assert got[1].asDict() == {
        "page_id": 1, "t_IDs": "7", "t_names": "귀여운 & 제목", "t_auth": "작가A / 작가B", "t_genre": "일상, 개그",
        "t_age": "12세 이용가", "t_sum": "첫 줄둘째 줄", "t_thumbs": "/img/1.jpg", "t_urls": "/list?titleId=7",
    }
    assert got[2].t_age == "연령가 없음"
    assert got[3].t_names is None and got[3].t_IDs is None


def test_daily_records_join_weekdays_and_comments(spark):
    anchors = P.page_anchors(listing(spark)).select("pos", "href", "text")
    got = {r.page_id: r for r in C.daily_records(pages(spark), anchors).collect()}
    assert got[1].t_weekdays == ["mon", "tue"] and got[1].t_comments == ["좋아요 정말", "둘 째"]
    assert got[3].t_weekdays == [] and got[3].t_comments == []
    apart = spark.createDataFrame([(1, '<p class="u_cbox_contents">only</p>')], "page_id long, html string")
    got = {r.page_id: r for r in C.daily_records(pages(spark), anchors, comment_pages=apart).collect()}
    assert got[1].t_comments == ["only"] and got[2].t_comments is None


def test_a_crowded_name_does_not_multiply_rows(spark):
    titles = spark.range(300).select("id", F.lit("same").alias("name"))
    anchors = spark.range(500).select(
        F.lit("same").alias("text"), F.col("id").alias("pos"),
        F.format_string("/l?t=%d&weekday=%s", "id", F.when(F.col("id") % 2 == 0, "fri").otherwise("mon")).alias("href"),
    )
    got = L.weekday_lookup(titles, anchors, "name")
    assert got.count() == 300 and got.select("weekdays").distinct().collect() == [(["fri", "mon"],)]


def test_links_of_a_page_and_of_a_section(spark):
    links = P.page_links(listing(spark), "https://h").orderBy("pos").collect()
    assert len(links) == 4 and links[0].link == "https://h/list?titleId=7&weekday=mon"
    part = P.page_links(listing(spark), "https://h", within=(r'(?s)<div class="col">(.*?)</div>', 0)).collect()
    assert [r.href for r in part] == ["/list?titleId=7&weekday=mon"]
    assert P.page_links(listing(spark), "https://h", within=(r"(?s)<nav>(.*?)</nav>", 0)).count() == 0


def test_rated_links(spark):
    html = "".join(
        f'<li><dl><dt><a href="/l?id={i}">t</a></dt><dd><div><strong>{r}</strong></div></dd></dl></li>'
        for i, r in enumerate(["9.90", "9.89", "new", "10"])
    )
    df = spark.createDataFrame([(1, html + "<li>no link<strong>9.95</strong></li>")], "page_id long, html string")
    assert [r.href for r in P.rated_links(df, "https://h").orderBy("pos").collect()] == ["/l?id=0", "/l?id=3"]


def test_comment_page_link(spark):
    got = {r.page_id: r.link for r in C.comment_page_links(pages(spark), "https://h/").collect()}
    assert got[1] == "https://h/comment/comment.nhn?titleId=7&no=52#"


def test_attribute_list(spark):
    df = spark.createDataFrame([('<p class="badge">월</p><p class="badge">화</p>',)], "html string")
    assert df.select(P.page_attr_list(F.col("html"), '<p class="badge">(.*?)</p>')).first()[0] == ["월", "화"]


def test_inner_text(spark):
    df = spark.createDataFrame([("<b>a</b> &lt;i&gt; &amp;lt; &#39;x&#39;",)], "x string")
    assert df.select(H.inner_text(F.col("x"))).first()[0] == "a <i> &lt; 'x'"


def test_site_day_and_weekday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-07 15:30:00' AS ts")
    assert tuple(df.select(D.day_key(F.col("ts")), D.weekday_code(F.col("ts"))).first()) == ("20240108", "mon")


def test_fields_stay_in_their_container(spark):
    side = '<div class="side"><span class="age">18</span><span>other</span><img src="/x.png"><p>far</p></div>'
    html = """<SPAN id=1 CLASS='big title'>Name</SPAN><p class="detail_info"></p><div class="thumb"></div><div class="detail"><h2>h</h2></div>""" + side
    df = spark.createDataFrame([(1, "/list?titleId=7", html)], "page_id long, url string, html string")
    r = C.detail_records(df).first()
    assert r.t_names == "Name" and r.t_age == "연령가 없음" and r.t_genre is None and r.t_thumbs is None and r.t_sum is None


def test_links_in_any_spelling(spark):
    html = """<abbr href="/no">x</abbr><a href='/x'>1</a><A HREF="/y?a=1&amp;b=2">2</A><a class=z href=/z>3</a><a href="">4</a><a>5</a>"""
    df = spark.createDataFrame([(1, "/", html)], "page_id long, url string, html string")
    assert [r.href for r in P.page_links(df, "https://h").orderBy("pos").collect()] == ["/x", "/y?a=1&b=2", "/z"]
    assert [(r.href, r.text) for r in P.page_anchors(df).orderBy("pos").collect()][:3] == [("/x", "1"), ("/y?a=1&b=2", "2"), ("/z", "3")]


def test_escaped_and_missing_parts_of_a_comment_link(spark):
    rows = [
        (1, "/list?titleId=7", '<td class="title"><a href="/d?titleId=7&amp;no=52">52</a></td>'),
        (2, "/list?titleId=8", '<td class="x title y"><a>no link</a></td><a href="/d?no=1">elsewhere</a>'),
        (3, "/list", '<td class="title"><a href="/d?no=5">5</a></td>'),
    ]
    got = {r.page_id: r.link for r in C.comment_page_links(spark.createDataFrame(rows, "page_id long, url string, html string"), "https://h").collect()}
    assert got == {1: "https://h/comment/comment.nhn?titleId=7&no=52#", 2: None, 3: None}


def test_comments_with_tags_inside(spark):
    html = '<span class="u_cbox_contents">a<span>b</span>c</span><div class=\'q u_cbox_contents\'>d<p>e</p><div>f</div>g</div><p class="u_cbox_contents">h</p>'
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(P.page_comments(F.col("html"))).first()[0] == ["abc", "defg", "h"]
    long = '<span class="u_cbox_contents">' + "x <b>y</b> " * 20000 + "</span>"
    assert len(spark.createDataFrame([(long,)], "html string").select(P.page_comments(F.col("html"))).first()[0][0]) == 80000


def comments_of(spark, html):
    return spark.createDataFrame([(html,)], "html string").select(P.page_comments(F.col("html"))).first()[0]


def test_comments_of_any_depth(spark):
    deep = "<div>" * 40 + "x" + "</div>" * 40
    html = f"""<!-- <div class="u_cbox_contents"> --><DIV class=u_cbox_contents>a<div>b<div>c<div>d</div>e</div>f</div>g</DIV>
    <p class="u_cbox_contents">1 < 2<!-- </p> --></p><div class="q u_cbox_contents z">{deep}</div>"""
    assert comments_of(spark, html) == ["abcdefg", "1 < 2", "x"]


def test_comments_inside_comments_and_without_an_end(spark):
    own = '<div class="u_cbox_contents">'
    assert comments_of(spark, f"{own}a{own}b{own}c</div></div>d</div>{own}e</div>") == ["abcd", "bc", "c", "e"]
    assert comments_of(spark, f"{own}never{own}ends</div>") == ["ends"]
    assert comments_of(spark, f"{own}</div>") == [""] and comments_of(spark, "") == [] and comments_of(spark, None) is None


def test_fields_of_nested_containers(spark):
    html = """<div class="thumb"><div><i></i></div><div><img alt='' src='/in.png'></div></div><img src="/out.png">
    <div class="detail"><div>x</div><h2>h</h2><p>sum</p></div><span class="title">A<span>B</span>C</span>"""
    df = spark.createDataFrame([(1, "/list?titleId=7", html)], "page_id long, url string, html string")
    r = C.detail_records(df).first()
    assert (r.t_thumbs, r.t_sum, r.t_names) == ("/in.png", "sum", "ABC")


def test_attribute_values_are_bare(spark):
    html = """<img alt="mon"><IMG alt='t"u'><img x=1 alt=wed><img alt=""><img alt="a<b&amp;c">"""
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(P.page_attr_list(F.col("html"), H.attribute("img", "alt"))).first()[0] == ["mon", 't"u', "wed", "a<b&c"]
    assert df.select(H.field_text(F.col("html"), H.attribute("img", "alt"))).first()[0] == "mon"
    lists = {"key_words": H.attribute("img", "alt")}
    assert C.k_records(df.withColumn("url", F.lit("/1")), {}, lists).first().key_words == ["mon", 't"u', "wed", "a<b&c"]


def test_weekday_lookup_keeps_a_column_named_text(spark):
    titles = spark.createDataFrame([("a", "kept")], "name string, text string")
    anchors = spark.createDataFrame([("a", "/l?t=1&weekday=mon", 0)], "text string, href string, pos int")
    assert L.weekday_lookup(titles, anchors, "name").first().asDict() == {"name": "a", "text": "kept", "weekdays": ["mon"]}


def test_k_records_have_the_columns_of_a_crawl(spark):
    df = spark.createDataFrame([("https://k/c/12?x=1", "<b>T</b>"), ("https://k/c/none", "<b>U</b>")], "url string, html string")
    rows = C.k_records(df, {"title": "<b>(.*?)</b>"}, {}).collect()
    assert len(rows[0]) == 15 and [(r.serial, r.title, r.day) for r in rows] == [("12", "T", []), (None, "U", [])]
    assert len(C.k_records(df, {}, {}, weekday=False).columns) == 14
