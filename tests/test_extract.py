"""Shop markup fixtures."""

from offerwell.operators import extract as B


def cards(spark, shop, html):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    return [r.asDict() for r in B.extract_cards(pages, B.CARD_RULES[shop]).orderBy("position").collect()]


def test_jumia(spark):
    html = """<article class="prd _fb"><a class="core" href="/a.html"><h3 class="name">Câble &amp; co</h3>
      <div class="prc">1 299,00 Dhs</div><div class="old">1.599,00 Dhs</div><div class="bdg _dsct">-19%</div>
      <div class="stars _s" style="width:84%"></div></a></article><article class="prd"><h3 class="name"></h3></article>"""
    (c,) = cards(spark, "jumia", html)
    assert (c["titre"], c["prixOffre"], c["prixInitial"], c["valeurOffre"]) == ("Câble & co", 1299.0, 1599.0, 19.0)
    assert (c["rating"], c["link"], c["location"]) == ("84%", "https://www.jumia.ma/a.html", "Maroc")


def test_amazon_needs_an_item_number_and_takes_direct_children(spark):
    html = """<div data-component-type="s-search-result" data-asin="B000000001"><h2><a class="a-link-normal"
      href="/x/dp/B000000001/ref=1?y=2"><span class="a-text-normal">Lampe</span></a></h2>
      <span class="a-price"><span class="a-offscreen">15,99 €</span></span>
      <span class="a-price a-text-price"><span class="a-offscreen">19,99 €</span></span>
      <span aria-label="4,3 sur 5 étoiles"></span></div>
      <div data-component-type="s-search-result" data-asin=""><h2><span>Sans</span></h2></div>"""
    (c,) = cards(spark, "amazon", html)
    assert c["link"] == "https://www.amazon.fr/dp/B000000001" and c["rating"] == "4.3"
    assert (c["prixOffre"], c["prixInitial"], c["valeurOffre"]) == (15.99, 19.99, 20.01)


def test_steam_and_electroplanet(spark):
    html = """<div id="search_resultsRows"><a class="search_result_row" href="https://s/app/1?x=1" data-ds-appid="1">
      <span class="title">Jeu</span><div class="discount_pct">-75%</div><div class="discount_original_price">19,99€</div>
      <div class="discount_final_price">Gratuit</div>
      <span class="search_review_summary" data-tooltip-html="Très positives&lt;br&gt;91% des avis"></span></a></div>"""
    (c,) = cards(spark, "steam", html)
    assert (c["prixOffre"], c["prixInitial"], c["valeurOffre"], c["key"]) == (0.0, 19.99, 75.0, "1")
    assert c["link"] == "https://s/app/1" and c["rating"] == "Très positives 91% des avis"
    html = """<li class="item product product-item"><a class="product-item-link" href="https://e/1"><span>LG</span>
      <span>Frigo</span></a><div class="special-price"><span class="price">900,00 DH</span></div>
      <div class="old-price"><span class="price">1000,00 DH</span></div></li>"""
    (c,) = cards(spark, "electroplanet", html)
    assert (c["titre"], c["seller"], c["typeOffre"], c["valeurOffre"]) == ("LG Frigo", "LG", "pourcentage", 10.0)


def test_avito_and_deals(spark):
    html = """<a class="sc-1jge648-0" href="/x"><p class="sc-1x0vz2r-0 iHApav">Vélo</p>
      <span class="sc-3286ebc5-2">1 500</span><div class="sc-3286ebc5-5">Promo</div></a>"""
    (c,) = cards(spark, "avito", html)
    assert (c["titre"], c["prixOffre"], c["typeOffre"], c["valeurOffre"]) == ("Vélo", 1500.0, "forfaite", None)
    html = """<div data-asin=""><a href="/y/dp/B000000009"></a><p><span>Casque audio</span></p>
      <span class="a-price"><span class="a-offscreen">Deal: 10,00 €</span></span>
      <span class="a-text-price"><span class="a-offscreen">List: 20,00 €</span></span></div>"""
    (c,) = cards(spark, "amazon_deals", html)
    assert (c["key"], c["prixInitial"], c["prixOffre"], c["valeurOffre"]) == ("B000000009", 20.0, 10.0, 50.0)


def test_heuristic_cards(spark):
    card = """<li><a href="/f-1-tv.html?src=1"><h3>SAMSUNG Televiseur 55</h3></a><a href="/f-1-tv.html#avis">avis</a>
      <span>499,00 €</span><span>499,00&nbsp;€</span><del>599,00 €</del><b>-16%</b>
      <i aria-label="4,5 étoiles sur 5"></i></li>"""
    html = f'<ul>{card}<li><a href="/aide/x.html"><h3>Centre d\'aide</h3></a> 3 €</li></ul>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    (c,) = B.extract_cards_heuristic(pages, "https://www.cdiscount.com", "cdiscount.com").collect()
    assert (c["price_offre"], c["price_initial"], c["valeur"]) == ("499,00 €", "599,00 €", 16.0)
    assert (c["seller"], c["rating"], c["link"]) == ("SAMSUNG", "4.5", "https://www.cdiscount.com/f-1-tv.html")


def test_links_blocks_profile(spark):
    html = '<a href="/p.html">x</a><a href="/aide/q.html">y</a><div class="card big">Enter the characters € 12,5</div>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r["href"] for r in B.product_links(pages).collect()] == ["/p.html"]
    assert B.flag_blocked(pages).first()["is_blocked"]
    profile = {r["item"]: r["n"] for r in B.page_profile(pages, 'class="([^"]*)"', 5, ["card"]).collect()}
    assert profile["big"] == 1 and profile["price"] == 1


def test_unclosed_tags_do_not_end_the_task(spark):
    deep = "<div>" * 5_000 + '<article class="prd"><h3 class="name">Tief</h3><div class="prc">10 Dhs</div></article>'
    (c,) = cards(spark, "jumia", deep)
    assert (c["titre"], c["prixOffre"]) == ("Tief", 10.0)
    items = '<ul>' + '<li class="x">a' * 5_000 + '</ul><article class="prd"><h3 class="name">B</h3><div class="prc">1 Dhs</div></article>'
    (c,) = cards(spark, "jumia", items)
    assert c["titre"] == "B"


def test_a_list_item_ends_the_one_before():
    page = B._Page("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>")
    depth = [len(list(n.walk())) for n in page.root.walk() if n.tag == "li"]
    assert depth == [0, 0]
    assert ["".join(n.texts()) for n in page.root.walk() if n.tag == "td"] == ["c", "d", "e"]
