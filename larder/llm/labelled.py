"""The labelled table of the block classifier: hand-written pages whose main blocks carry `data-main`."""

_W = ("the harbour office said on monday that two ferries will sail each hour between the island and the town while the bridge is "
      "closed for repair and that tickets bought in advance remain valid on every crossing until the end of the season")
_LONG = " ".join([_W.capitalize() + "."] * 3)
_MID = "The council voted for the plan after a short debate, and work begins in spring."
_SHORT = "Boats leave early."
_ONE = _W.capitalize() + "."
_SOME = "Each crossing takes about twenty minutes in calm weather, and bicycles travel free of charge on all boats after nine in the morning."

PAGES = [
    # An article with the usual parts around it.
    f"""<html><head><title>News</title><style>p{{}}</style></head><body><header><a href="/">Island Post</a> <p>All the news of the coast since 1901</p></header>
    <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li><a href="/c">Sport</a></li></ul></nav>
    <div class="ad">{_MID}</div><article><h1 data-main>Ferries to sail each hour</h1><p data-main>{_LONG}</p><p data-main>{_SHORT}</p>
    <p data-main>{_MID}</p><ul><li data-main>{_SHORT}</li><li data-main>Bring a ticket and warm clothes.</li></ul><h2 data-main>Repairs</h2><p data-main>{_LONG}</p>
    <div class="share"><a href="#">Share</a> <a href="#">Print</a></div></article>
    <aside class="sidebar"><h3>Most read</h3><p>{_MID}</p><ul><li><a href="/1">{_MID}</a></li></ul></aside>
    <section class="comments"><h2>Comments</h2><p>{_MID}</p><p>{_LONG}</p></section><footer><p>Copyright Island Post. {_MID}</p></footer></body></html>""",
    # One long paragraph, and notices.
    f"""<body><div id="cookie-notice"><p>We use cookies. {_MID}</p><button>OK</button></div><main><h1 data-main>Notes</h1><p data-main>{_LONG}</p></main>
    <form><p>Write to us: {_MID}</p></form><div class="newsletter"><p>{_MID}</p></div><div class="footer"><p>{_LONG}</p></div></body>""",
    # Short paragraphs only.
    f"""<body><nav><a href="/">Home</a> | <a href="/x">Archive</a></nav><div class="ad">Buy now.</div><article><h1 data-main>Tides</h1><p data-main>High.</p>
    <p data-main>{_SHORT}</p><p data-main>Low.</p></article><footer>&copy; Tide table &middot; {_SHORT}</footer></body>""",
    # No telling names: text blocks among blocks of links.
    f"""<body><div><a href="/">Home</a> <a href="/n">News</a> <a href="/w">Weather</a></div><div><a href="/1">{_SHORT}</a></div><div><h1 data-main>Ferries to sail</h1></div>
    <div data-main>{_LONG}</div><div data-main>{_MID} See <a href="/t">tickets</a>.</div><div data-main>{_LONG}</div><div><a href="/p">Back</a> <a href="/q">Next page</a></div>
    <div>Contact</div></body>""",
    f"""<body><table><tr><td><a href="/">Start</a></td><td><a href="/l">Links</a></td></tr></table><p data-main>{_LONG}</p><p data-main>{_MID}</p><p data-main>{_LONG}</p>
    <p><a href="/u">Up</a></p><p>Page 3</p></body>""",
    f"""<body><ul><li><a href="/">Home</a></li><li><a href="/s">Shop</a></li></ul><div data-main>{_LONG}</div><div data-main>{_MID}</div><div data-main>{_LONG}</div>
    <ul><li><a href="/r">{_MID}</a></li><li><a href="/r2">{_SHORT}</a></li></ul><div>All rights reserved</div></body>""",
    # Containers named by class.
    f"""<body><div class="site-header"><h1><a href="/">Coast blog</a></h1></div><div class="post entry-content"><h2 data-main>Spring</h2><p data-main>{_MID}</p>
    <blockquote data-main>{_SHORT}</blockquote><p data-main>{_LONG}</p></div><div class="widget"><p>{_LONG}</p></div><div id="comments"><div class="comment">{_MID}</div></div>
    <div class="related"><h3>Related</h3><p>{_SHORT}</p></div></body>""",
    f"""<body><div class="promo banner">{_LONG}</div><div class="story"><p data-main>{_SHORT}</p><p data-main>{_MID}</p><ol><li data-main>{_MID}</li><li data-main>{_SHORT}</li></ol></div>
    <div class="login"><p>{_SHORT}</p></div><div role="complementary"><p>{_MID}</p></div><div role="contentinfo">{_SHORT}</div></body>""",
    # An article with links inside its text, and a list of links after it.
    f"""<body><article><header><h1 data-main>Guide</h1></header><p data-main>{_MID} <a href="/a">{_SHORT}</a></p><p data-main><a href="/b">{_MID}</a> {_MID}</p>
    <table><tr><td data-main>{_SHORT}</td><td data-main>Four</td></tr></table><pre data-main>{_MID}</pre></article><div><a href="/z">{_MID}</a></div><div>Imprint</div></body>""",
    # Paragraphs of middling length without telling names.
    f"""<body><div><a href="/">Home</a></div><div><p data-main>{_SOME}</p><p data-main>{_MID}</p><p data-main>{_ONE}</p><p data-main>{_SOME}</p><p data-main>{_MID}</p></div>
    <div><a href="/1">{_MID}</a></div><div><a href="/2">{_SHORT}</a></div><div>Printed in the harbour</div></body>""",
    f"""<body><p>Coast blog</p><p><a href="/x">About us</a></p><p data-main>{_MID}</p><p data-main>{_SOME}</p><p data-main>{_ONE}</p><p data-main>{_MID}</p><p data-main>{_SOME}</p>
    <p><a href="/next">Next</a></p><p>Terms of use</p></body>""",
    f"""<body><p><a href="/x">Coast blog</a></p><p data-main>{_ONE}</p><p data-main>{_ONE}</p><p data-main>{_SOME}</p><p data-main>{_ONE}</p><p>{_SHORT}</p><p><a href="/y">{_SOME}</a></p></body>""",
    # Teasers: long texts that are links.
    f"""<body><div><a href="/1">{_ONE}</a></div><div><a href="/2">{_LONG}</a></div><div><a href="/3">{_SOME}</a> {_SHORT}</div><p data-main>{_SOME}</p><p data-main>{_LONG}</p>
    <p data-main>{_ONE}</p><div><a href="/4">{_ONE}</a></div><div><a href="/5">{_SOME}</a></div><div><a href="/6">{_LONG}</a></div></body>""",
]
