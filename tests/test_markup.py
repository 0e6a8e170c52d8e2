import hashlib

from guestlens.operators import market
from guestlens.sources import markup

PAGE = """<html><head><title>Hotel Nord &amp; Süd, Town | Site</title></head><body><h2>Facilities</h2>
<h2 class="t">Guest reviews for <b>Hotel Nord</b></h2>
<div data-testid="review-card"><div data-testid="review-author-name"> Ann </div><h4 data-testid="review-title">Good &amp; "fine"</h4>
<div data-testid="review-positive-text"><span>Nice<br> staff</span></div><div data-testid="review-score"><div>Scored 9,5</div></div>
<span data-testid="review-stay-date">May 2025</span><span data-testid="review-traveler-type">Couple</span>
<img src="https://x/flags/pl.png" alt=" Poland "></div>
<div class="c" data-testid="review-card"><div data-testid="review-author-name">Bob</div><div data-testid="review-negative-text">Dirty
shower</div></div>
<div data-testid="review-card"><h4 data-testid="review-title">Only a title</h4><div data-testid="review-positive-text"> </div></div>
<select data-testid="scoreRange"><option value="ALL">All (1234)</option><option value="REVIEW_ADJ_SUPERB" selected>Wonderful: 9+ (1000)</option>
<option value="REVIEW_ADJ_POOR">Poor: 3-5 (7)</option><option value="REVIEW_ADJ_VERY_POOR">Very poor: 1-3</option></select>
<select class="s" data-testid="customerType"><option value="ALL">All (1234)</option><option value="GROUP_OF_FRIENDS">Groups (12)</option></select>
<select data-testid="languages"><option value="0">All (1234)</option><option value="pl">Polish (700)</option><option value="en">English (500)</option></select>
</body></html>"""


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "hotel_name string, html string")


def test_cards(spark):
    rows = markup.extract_cards(pages(spark, ("Hotel Nord", PAGE), ("Empty", "<html></html>"), ("None", None))).collect()
    assert len(rows) == 2
    ann, bob = sorted(rows, key=lambda r: r["title"], reverse=True)
    assert ann["title"] == 'Good & "fine"' and ann["pos_text"] == "Nice\nstaff" and ann["rating_score"] == 9.5
    assert (ann["stay_date"], ann["traveler_type"], ann["reviewer_country"]) == ("May 2025", "Couple", "Poland")
    assert ann["source_id"] == hashlib.md5('Hotel Nord|Ann|Good & "fine"'.encode()).hexdigest()
    assert (bob["neg_text"], bob["rating_score"], bob["reviewer_country"], bob["traveler_type"]) == ("Dirty\nshower", 0.0, "Unknown", "")


def test_nested_fields_entities_and_page_end(spark):
    page = """<div data-testid="review-card"><h4 data-testid="review-title">T</h4><div data-testid="review-negative-text"><div>first part</div>
<div>second <b>part</b><p>third</p></div></div></div><p>after</p><div data-testid="review-score">Scored 3</div>
<div data-testid="review-card"><div data-testid="review-positive-text">caf&eacute; &#8217;nice&#8217;<br>good &amp;lt; x</div></div>
<div data-testid="review-traveler-type">Couple</div>"""
    one, two = sorted(markup.extract_cards(pages(spark, ("h", page))).collect(), key=lambda r: r["title"], reverse=True)
    assert one["neg_text"] == "first part\nsecond part\nthird" and one["rating_score"] == 0.0
    assert two["pos_text"] == "caf\u00e9 \u2019nice\u2019\ngood &lt; x" and two["traveler_type"] == ""


def test_menus_and_distribution_row(spark):
    counts = markup.extract_counts(pages(spark, ("Hotel Nord", PAGE), ("Empty", "<html></html>")), carry=["hotel_name"])
    rows = {r["hotel_name"]: r for r in market.distribution_rows(counts).collect()}
    full, empty = rows["Hotel Nord"], rows["Empty"]
    assert (full["total"], full["wonderful_9plus"], full["poor_3to5"], full["very_poor_1to3"], full["negative_total"]) == (1234, 1000, 7, 0, 7)
    assert (full["type_group_of_friends"], full["type_families"]) == (12, 0)
    assert full["languages_json"] == '{"pl":700,"en":500}'
    assert empty["total"] == 0 and empty["languages_json"] == "{}"
    options = markup.menu_options(pages(spark, ("h", PAGE)), "languages", carry=["hotel_name"]).collect()
    assert {(r["value"], r["reviews"]) for r in options} == {("0", 1234), ("pl", 700), ("en", 500)}


def test_hotel_name(spark):
    rows = [
        ("a", PAGE),
        ("b", "<title>Inn &amp; Bar | Site</title>"),
        ("c", "<title> Inn, Town | Site</title><h2>Other</h2>"),
        ("d", "<title>Plain</title>"),
    ]
    from pyspark.sql import functions as F

    got = {r["hotel_name"]: r["n"] for r in pages(spark, *rows).select("hotel_name", markup.hotel_name(F.col("html")).alias("n")).collect()}
    assert got == {"a": "Hotel Nord", "b": "Inn & Bar", "c": "Inn", "d": "Plain"}
