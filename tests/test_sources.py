"""Raw and clean files."""

import json

from pyspark.sql import functions as F

from offerwell.operators.normalise import normalise
from offerwell.sources import listings as A


def test_raw_array_file(spark, tmp_path):
    records = [
        {"title": " TV  55 ", "price_initial": "1 715,06 €", "price_offre": "1 500 €", "offre": [{"type_offre": "pourcentage", "valeur_offre": "12%"}], "link": "l1", "rating": "4.5", "date": "2026-03-29", "location": ""},
        {"title": "Câble", "price_offre": "95,66 €", "offre": None, "link": "l2"},
        {"titre": "Autre", "prixInitial": 20.0, "prixOffre": 20.0, "offre": [], "link": "l3"},
    ]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(records, ensure_ascii=False, indent=2), encoding="utf-8")
    rows = {r["link"]: r for r in normalise(A.read_raw(spark, str(path), multiline=True), "amazon", "2026-04-01").collect()}
    a, b, c = rows["l1"], rows["l2"], rows["l3"]
    assert (a["title_clean"], a["price_initial"], a["price_offre"], a["discount_pct"]) == ("TV 55", 1715.06, 1500.0, 12.0)
    assert (a["location"], a["offre_type"], str(a["date"])) == ("Amazon.fr", "pourcentage", "2026-03-29")
    assert (b["price_initial"], b["price_offre"], b["price_initial_mad"]) == (95.66, None, 1037.91)
    assert (c["title_clean"], c["price_initial"], c["price_offre"], c["discount_pct"]) == ("Autre", 20.0, None, None)


def test_base_price_stands_in_for_a_zero_offer(spark):
    df = spark.createDataFrame([("T", 10.0, 8.0, 0.0, "l")], "titre string, prixInitial double, prixBase double, prixOffre double, link string")
    row = normalise(df, "jumia", "2026-04-01").first()
    assert (row["price_initial"], row["price_offre"], row["currency"], row["discount_pct"]) == (10.0, 8.0, "MAD", 20.0)


def test_clean_csv_with_byte_order_mark(spark, tmp_path):
    from offerwell.constants import FINAL_COLUMNS

    values = ["a", "Amazon", 'x "y", z', "1.5", "", "EUR", "oops", "", "10.85", "", "s", "l", "c", "4", "2026-01-02", "u", "", "False"]
    quoted = ",".join('"' + v.replace('"', '""') + '"' if '"' in v else v for v in values)
    path = tmp_path / "c.csv"
    path.write_text("﻿" + ",".join(FINAL_COLUMNS) + "\n" + quoted + "\n", encoding="utf-8")
    row = A.read_clean_csv(spark, str(path)).first()
    assert (row["title_clean"], row["price_initial"], row["price_initial_mad"], row["is_duplicate"]) == ('x "y", z', 1.5, None, False)


def test_line_breaks_do_not_break_clean_csv(spark, tmp_path):
    from offerwell.constants import FINAL_COLUMNS

    cells = [F.lit("a\r\nb").alias(c) if c == "title_clean" else F.lit(None).cast(A.CLEAN_TYPES.get(c, "string")).alias(c) for c in FINAL_COLUMNS]
    paths = A.write_clean(spark.range(3).select(*cells), str(tmp_path / "out"))
    assert [r["title_clean"] for r in A.read_clean_csv(spark, paths["csv"]).collect()] == ["a b"] * 3
    assert [r["title_clean"] for r in A.read_clean_json(spark, paths["json"]).collect()] == ["a\r\nb"] * 3


def test_packed_text_files_read_back_the_same(spark, tmp_path):
    cells = [F.lit("a é\n" if A.CLEAN_TYPES.get(c, "string") == "string" else None).cast(A.CLEAN_TYPES.get(c, "string")).alias(c) for c in A.FINAL_COLUMNS]
    rows = spark.range(50).select(*cells)
    plain = A.write_clean(rows, str(tmp_path / "plain"), ["csv", "json"])
    packed = A.write_clean(rows, str(tmp_path / "packed"), ["csv", "json"], compression="gzip")
    for fmt, read in (("csv", A.read_clean_csv), ("json", A.read_clean_json)):
        assert {p.name.split(".", 1)[1] for p in (tmp_path / "packed" / fmt).glob("part-*")} == {f"{fmt}.gz"}
        size = [sum(p.stat().st_size for p in (tmp_path / n / fmt).glob("part-*")) for n in ("plain", "packed")]
        assert size[1] < size[0] / 3
        assert read(spark, packed[fmt]).collect() == read(spark, plain[fmt]).collect()
