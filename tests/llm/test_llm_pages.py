"""Main text of pages written by hand, not by the generator that the model learns from."""

import pytest

from cadenza.llm import html_extract

P = {}
P["news"] = ("""<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>River levels</title><style>p{margin:0}</style><script>var a="<p>not text</p>";</script></head>
<body><header class="site-header"><a href="/">The Valley Post</a><nav><ul><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li><li><a href="/weather">Weather</a></li></ul></nav></header>
<main><article><h1>River levels fall after a wet spring</h1><p class="byline">By Ana Roth</p><p>After three weeks of steady rain the river has begun to fall, and the water board says that the worst of the flooding is over for this season.</p>
<p>Engineers opened two of the four gates on Monday &amp; expect to close them again before the end of the week, when the forecast is dry.</p><h2>What happens next</h2><p>Residents of the lower town have been told to keep their sandbags until the inspection of the east bank has been finished.</p></article>
<aside class="related"><h3>Most read</h3><ul><li><a href="/a">Bridge to close for repairs</a></li><li><a href="/b">School wins regional cup</a></li></ul></aside></main>
<section id="comments"><h3>Comments</h3><div class="comment"><p>Great news for all of us who live by the water, finally some rest.</p></div><div class="comment"><p>They said the same thing last year and look what happened then.</p></div></section>
<footer><p>Copyright 2024 The Valley Post. All rights reserved.</p><a href="/terms">Terms</a> <a href="/privacy">Privacy</a></footer></body></html>""",
["River levels fall after a wet spring","By Ana Roth","After three weeks of steady rain the river has begun to fall, and the water board says that the worst of the flooding is over for this season.","Engineers opened two of the four gates on Monday & expect to close them again before the end of the week, when the forecast is dry.","What happens next","Residents of the lower town have been told to keep their sandbags until the inspection of the east bank has been finished."])
P["soup"] = ("""<html><body><div id=top><div class=menu><a href=1>Home</a> <a href=2>About</a> <a href=3>Contact us</a></div></div><div class=wrap><div class=left><div class=box>Subscribe to our newsletter and never miss a post again</div><div class=box><a href=x>Archive</a><br><a href=y>Tags</a></div></div>
<div class=post><div class=title>How I repaired an old clock</div><div class=text>My grandfather left me a clock that had not moved for thirty years, so one long winter I decided to take it apart on the kitchen table.</div><div class=text>The mainspring was fine, but the oil had turned to a brown glue that held every wheel in its place, and cleaning it took me most of a week.</div><div class=text>It has kept good time ever since, apart from the day when the cat found the pendulum.</div></div></div>
<div class=cookie>We use cookies to improve your experience. <a href=c>Accept</a> <a href=d>Decline</a></div><div class=foot>Powered by SimpleBlog - <a href=r>RSS</a></div></body></html>""",
["How I repaired an old clock","My grandfather left me a clock that had not moved for thirty years, so one long winter I decided to take it apart on the kitchen table.","The mainspring was fine, but the oil had turned to a brown glue that held every wheel in its place, and cleaning it took me most of a week.","It has kept good time ever since, apart from the day when the cat found the pendulum."])
P["docs"] = ("""<html><head><title>Install</title></head><body><nav class="sidebar"><ul><li><a href="#i">Install</a></li><li><a href="#u">Usage</a></li><li><a href="#f">FAQ</a></li></ul></nav><div class="content" role="main"><h1>Installing the tool</h1><p>The tool runs on any machine with four gigabytes of memory and needs no other software to be installed before it.</p><ol><li>Download the archive for your system and unpack it in a folder of your choice.</li><li>Add that folder to the search path, so that the command can be found from anywhere.</li></ol><blockquote>Older versions must be removed first, because two versions cannot share one settings file.</blockquote><table><tr><td>Linux</td><td>tool.tar.gz</td></tr></table></div><div class="feedback"><form action="/f"><label>Was this page helpful?</label><button>Yes</button><button>No</button></form></div><footer>Version 3.2 <a href="/e">Edit this page</a></footer></body></html>""",
["Installing the tool","The tool runs on any machine with four gigabytes of memory and needs no other software to be installed before it.","Download the archive for your system and unpack it in a folder of your choice.","Add that folder to the search path, so that the command can be found from anywhere.","Older versions must be removed first, because two versions cannot share one settings file.","Linux","tool.tar.gz"])
P["ad"] = ("""<html><body><div class="banner-ad"><p>Buy one pair of shoes and get the second pair for half the price, only this week!</p><a href="/buy">Shop now</a></div><section class="story"><h2>A walk along the coast path</h2><p>The path starts behind the old lighthouse and climbs slowly through heather until the whole bay lies open below.</p><figure><img src="a.jpg" alt="bay"><figcaption>The bay seen from the first hill.</figcaption></figure><p>Bring water, since there is no shop between the lighthouse and the harbour, which is a good four hours on foot.</p></section><div class="share"><a href="f">Share</a><a href="t">Tweet</a></div><div class="sponsored"><p>Sponsored: the best travel insurance for your next adventure starts here.</p></div></body></html>""",
["A walk along the coast path","The path starts behind the old lighthouse and climbs slowly through heather until the whole bay lies open below.","The bay seen from the first hill.","Bring water, since there is no shop between the lighthouse and the harbour, which is a good four hours on foot."])
P["forum"] = ("""<html><body><div class="topbar"><a href="/">Forum</a> | <a href="/login">Log in</a> | <a href="/register">Register</a></div><div class="notice">The forum will be down for maintenance on Sunday night.</div><article class="entry"><header><h1>Wie man Brot im Topf b&auml;ckt</h1></header><p>Ein schwerer Topf mit Deckel h&auml;lt den Dampf im Inneren, und genau dieser Dampf gibt dem Brot seine d&uuml;nne, knusprige Kruste.</p><p>Der Teig ruht &uuml;ber Nacht im K&uuml;hlschrank; am Morgen wird er nur noch gefaltet<br>und in den heissen Topf gelegt.</p><pre>500 g Mehl, 350 g Wasser, 10 g Salz</pre></article><div id="reader-comments"><p>Bei mir wurde es leider viel zu dunkel, vielleicht war der Ofen zu heiss.</p><form><textarea>Ihr Kommentar</textarea><input type="submit"></form></div><div class="pagination"><a href="1">1</a> <a href="2">2</a> <a href="3">3</a></div></body></html>""",
["Wie man Brot im Topf b\u00e4ckt","Ein schwerer Topf mit Deckel h\u00e4lt den Dampf im Inneren, und genau dieser Dampf gibt dem Brot seine d\u00fcnne, knusprige Kruste.","Der Teig ruht \u00fcber Nacht im K\u00fchlschrank; am Morgen wird er nur noch gefaltet und in den heissen Topf gelegt.","500 g Mehl, 350 g Wasser, 10 g Salz"])


@pytest.fixture(scope="module")
def model(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").limit(200)
    return html_extract.train([r.html for r in pages.collect()])


@pytest.mark.parametrize("name", P)
def test_pages_written_by_hand(model, name):
    source, blocks = P[name]
    assert html_extract.extract([source], model)[0].split("\n") == blocks
