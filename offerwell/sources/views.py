"""Domain tables (listings, bids, offers, ...) as views over the stored star schema.

Every derived column is written once, as an expression that Spark SQL and ANSI engines read the same way, so a check
in another engine sees the same input. ``SPARK`` and ``ANSI`` hold the few spellings that differ.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwell.session import cut_lineage

SPARK = {"div": "DIV", "unix_day": "cast(unix_date(cast(l_shipdate as date)) as bigint)", "arr": "array(", "end": ")"}
ANSI = {
    "div": "//",
    "unix_day": "date_diff('day', DATE '1970-01-01', cast(l_shipdate as date))",
    "arr": "list_value(",
    "end": ")",
}

_PRICE = "floor(l_extendedprice*100+0.5)/100"
_OFFER = "floor(l_extendedprice*(1-l_discount)*100+0.5)/100"
_CENTS = "cast(floor(l_extendedprice*100+0.5) as bigint)"
_OFFER_CENTS = "cast(floor(l_extendedprice*(1-l_discount)*100+0.5) as bigint)"
_PCT = "cast(floor(l_discount*100+0.5) as bigint)"


def _money_text(cents: str) -> str:
    whole, rest = f"({cents}) {{div}} 100", f"({cents}) % 100"
    return (
        f"CASE WHEN ({whole}) >= 1000 THEN concat(cast(({whole}) {{div}} 1000 as string), ' ', "
        f"lpad(cast(({whole}) % 1000 as string), 3, '0')) ELSE cast({whole} as string) END || ',' || "
        f"lpad(cast({rest} as string), 2, '0')"
    )


_UNIT = "CASE WHEN r_name IN ('AFRICA','ASIA') THEN ' DH' ELSE ' €' END"

LISTING = {
    "source": "CASE r_name WHEN 'AFRICA' THEN 'Jumia' WHEN 'AMERICA' THEN 'Amazon' WHEN 'ASIA' THEN 'Avito' "
    "WHEN 'EUROPE' THEN 'CDiscount' ELSE 'Steam' END",
    "currency": "CASE WHEN r_name IN ('AFRICA','ASIA') THEN 'MAD' ELSE 'EUR' END",
    "title": "p_name",
    "seller": "s_name",
    "location": "n_name",
    "category": "CASE p_type WHEN 'ECONOMY' THEN 'Smartphones' WHEN 'SMALL' THEN 'Accessoires' "
    "WHEN 'MEDIUM' THEN 'Informatique' WHEN 'PROMO' THEN 'Audio' WHEN 'STANDARD' THEN 'Maison' END",
    "price_initial": f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {_PRICE} END",
    "price_offre": f"CASE WHEN l_linenumber = 7 THEN {_PRICE} WHEN l_discount > 0.05 THEN {_OFFER} "
    f"WHEN l_discount > 0.03 THEN {_PRICE} END",
    "rating": "CASE WHEN l_tax > 0 THEN floor((5-l_tax*25)*100+0.5)/100 END",
    "offre_type": "CASE l_returnflag WHEN 'A' THEN 'pourcentage' WHEN 'R' THEN 'forfaite' ELSE '' END",
    "day": "cast(l_shipdate as date)",
    "link": "concat('https://shop.example/p/', cast(l_partkey as string), '-', cast(l_suppkey as string), '?ref=', "
    "cast(l_linenumber as string))",
    "orderkey": "l_orderkey",
    "linenumber": "l_linenumber",
    "partkey": "l_partkey",
    "suppkey": "l_suppkey",
    "cents": _CENTS,
}
# Total order of listings; (orderkey, linenumber) alone repeats.
LISTING_ORDER = ["orderkey", "linenumber", "partkey", "suppkey", "day", "cents"]

RAW = {
    "price_initial_text": f"CASE WHEN l_linenumber = 7 THEN '' ELSE {_money_text(_CENTS)} || {_UNIT} END",
    "price_offre_text": f"CASE WHEN l_linenumber = 7 THEN {_money_text(_CENTS)} || {_UNIT} || ' / mois' || {_UNIT} "
    f"WHEN l_discount > 0.05 THEN {_money_text(_OFFER_CENTS)} || {_UNIT} "
    f"WHEN l_discount > 0.03 THEN {_money_text(_CENTS)} END",
    "dotted_price_text": f"CASE WHEN ({_CENTS}) {{div}} 100 >= 1000 THEN concat(cast(({_CENTS}) {{div}} 100000 as "
    f"string), '.', lpad(cast((({_CENTS}) {{div}} 100) % 1000 as string), 3, '0')) ELSE "
    f"cast(({_CENTS}) {{div}} 100 as string) END || ',' || lpad(cast(({_CENTS}) % 100 as string), 2, '0') || ' Dhs'",
    "store_price_text": f"CASE WHEN l_discount = 0 THEN 'Gratuit' ELSE concat(cast({_CENTS} {{div}} 100 as string), "
    f"',', lpad(cast({_CENTS} % 100 as string), 2, '0'), '€') END",
    "badge": f"CASE WHEN l_discount > 0.06 THEN concat('-', cast({_PCT} as string), '%') "
    f"WHEN l_discount > 0.04 THEN concat(cast({_PCT}*10 as string), ',50', {_UNIT}) "
    f"WHEN l_discount > 0.03 THEN 'Offre limitée' WHEN l_discount > 0.02 THEN '' END",
    "rating_text": "CASE WHEN l_linenumber = 1 THEN concat('très positives ', cast(60+l_partkey%40 as string), '%') "
    "WHEN l_linenumber = 2 THEN concat('width:', cast(l_partkey%101 as string), '.5') "
    "WHEN l_linenumber = 3 THEN concat(cast(l_partkey%6 as string), '.', cast(l_suppkey%10 as string)) "
    "WHEN l_linenumber = 4 THEN 'n/a' END",
    "date_text": "CASE WHEN l_linenumber < 4 THEN cast(cast(l_shipdate as date) as string) "
    "WHEN l_linenumber = 4 THEN cast({unix_day}*86400000+3600000 as string) "
    "WHEN l_linenumber = 5 THEN 'il y a 2 jours' WHEN l_linenumber = 6 THEN 'hier' END",
    "raw_title": "concat('  ', p_name, ' \t ', p_brand, '  ')",
}
CARD = {
    "nodes": "{arr}concat(p_brand, ' ', p_name), " + f"{_money_text(_OFFER_CENTS)} || ' €', "
    f"{_money_text(_OFFER_CENTS)} || ' EUR', {_money_text(_CENTS)} || ' €', "
    f"CASE WHEN l_discount > 0.03 THEN concat(' -', cast({_PCT} as string), '% ') ELSE 'Remise de 100% immédiate' END, "
    "CASE WHEN l_tax > 0.04 THEN concat('note ', cast(l_partkey%5 as string), ',', cast(l_suppkey%10 as string), '/5') "
    "ELSE 'avis' END, "
    "CASE WHEN l_returnflag = 'A' THEN 'Vendu par' WHEN l_returnflag = 'R' THEN concat('Vendu et expédié par ', s_name) "
    "ELSE 'Livraison' END, s_name{end}",
    "aria": "CASE WHEN l_tax > 0.02 THEN concat(cast(l_partkey%5 as string), ',', cast(l_suppkey%10 as string), "
    "' sur 5 étoiles') ELSE '' END",
    "card_title": "CASE WHEN l_linenumber < 4 THEN concat(upper(p_type), ' ', p_name) ELSE p_name END",
}


# Known schemas spare one footer-reading job per table and query.
STORED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


#: Stored columns that the listing views read.
_STAR_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_extendedprice l_discount l_tax l_returnflag l_shipdate "
    "p_name p_brand p_type s_name n_name r_name"
).split()


class Tables:
    """Lazy access to the stored tables of one folder and to the domain views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def stored(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._open(name)
        return self._read[name]

    def _open(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(STORED[name]) if name in STORED else self.spark.read
        return reader.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.stored(name)

    @cached_property
    def _listing_rows(self) -> DataFrame:
        return (
            self.stored("lineitem")
            .join(self.stored("part"), F.expr("l_partkey = p_partkey"))
            .join(self.stored("supplier"), F.expr("l_suppkey = s_suppkey"))
            .join(self.stored("nation"), F.expr("s_nationkey = n_nationkey"))
            .join(self.stored("region"), F.expr("n_regionkey = r_regionkey"))
        )

    def _over(self, rows: DataFrame) -> Tables:
        other = Tables(self.spark, self.folder)
        other._read, other._listing_rows = self._read, rows
        return other

    def dealt(self) -> Tables:
        """The same tables, with the listing rows dealt evenly to all tasks.

        For row-wise work that costs more than a shuffle of the stored columns: a file of one row group is otherwise one task.
        """
        rows = self._listing_rows.select(_STAR_COLUMNS)
        return self._over(rows.repartition("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"))

    def written(self) -> Tables:
        """``dealt``, with the joined listing rows written once, for work that reads them several times."""
        return self._over(cut_lineage(self.dealt()._listing_rows, "listings"))

    def _listing_view(self, *groups: dict[str, str]) -> DataFrame:
        cols = {k: v for g in groups for k, v in g.items()}
        return self._listing_rows.selectExpr(*[f"{_spell(e, SPARK)} AS {n}" for n, e in cols.items()])

    @property
    def listings(self) -> DataFrame:
        return self._listing_view(LISTING)

    @property
    def raw_listings(self) -> DataFrame:
        return self._listing_view(LISTING, RAW)

    @property
    def cards(self) -> DataFrame:
        return self._listing_view(LISTING, CARD)

    @property
    def unified(self) -> DataFrame:
        """Listings after the price cases and the currency conversion."""
        from offerwell.functions.text import clean_title, row_id
        from offerwell.operators.normalise import unify

        rows = self.listings.withColumns(
            {
                "id": row_id(F.col("source"), F.col("link")),
                "title_clean": clean_title(F.col("title")),
                "pct": F.lit(None).cast("double"),
            }
        ).withColumnsRenamed({"price_initial": "p0", "price_offre": "p1"})
        return unify(rows, "p0", "p1", "pct")

    @property
    def products(self) -> DataFrame:
        return self.stored("part").selectExpr(*_items(PRODUCT))

    @property
    def offers(self) -> DataFrame:
        return self.stored("lineitem").join(self.stored("orders"), F.expr("l_orderkey = o_orderkey")).selectExpr(
            *_items(OFFER)
        )

    @property
    def bids(self) -> DataFrame:
        """Bids without round numbers: (negotiation, event_id, ts, bid)."""
        return self.stored("events").selectExpr("user_id AS negotiation", "event_id", "ts", "value AS bid")

    @property
    def messages(self) -> DataFrame:
        return self.stored("conversations").selectExpr(*_items(MESSAGE))

    @property
    def audits(self) -> DataFrame:
        return self.stored("events").selectExpr(*_items(AUDIT))


PRODUCT = {
    "product_id": "p_partkey",
    "title": "p_name",
    "brand": "p_brand",
    "category": LISTING["category"],
    "price": "p_retailprice",
    "price_min": "p_retailprice*0.85",
    "stock": "p_size",
}
# One offer per order line: the buyer proposes a unit price for one product.
OFFER = {
    "offer_id": "md5(concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', "
    "cast(l_partkey as string), '-', cast(l_suppkey as string), '-', "
    f"cast({_CENTS} as string), '-', cast(cast(l_shipdate as date) as string)))",
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "seller_id": "l_suppkey",
    "buyer_id": "o_custkey",
    "price_proposed": "floor(l_extendedprice/l_quantity*(1-l_discount)*100+0.5)/100",
    "price_final": "CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE floor(l_extendedprice/l_quantity*100+0.5)/100 END",
    "quantity": "cast(l_quantity as int)",
    "status": "CASE o_orderstatus WHEN 'O' THEN 'EN_ATTENTE' WHEN 'F' THEN 'VALIDEE' ELSE 'REJETEE' END",
    "created": "cast(o_orderdate as date)",
    "shipped": "cast(l_shipdate as date)",
}
OFFER_ORDER = ["created", "offer_id"]
MESSAGE = {
    "negotiation": "conv_id",
    "turn": "turn",
    "sender": "CASE role WHEN 'user' THEN 'ACHETEUR' WHEN 'assistant' THEN 'AGENT' ELSE 'SYSTEME' END",
    "price": "CASE WHEN length(text) % 7 = 0 THEN 0 ELSE 100 + length(text) % 50 END",
    "content": "text",
}
AUDIT = {
    "audit_id": "event_id",
    "ts": "ts",
    "agent": "user_id",
    "kind": "event_type",
    "severity": "CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'WARNING' "
    "WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END",
    "value": "value",
}


def _spell(expr: str, words: dict[str, str]) -> str:
    for token, word in words.items():
        expr = expr.replace("{" + token + "}", word)
    return expr


def _items(cols: dict[str, str], words: dict[str, str] = SPARK) -> list[str]:
    return [f"{_spell(e, words)} AS {n}" for n, e in cols.items()]


_STAR = (
    "lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


def ansi_views() -> dict[str, str]:
    """The same views as plain SELECT statements."""

    def select(cols: dict[str, str], source: str) -> str:
        return f"SELECT {', '.join(_items(cols, ANSI))} FROM {source}"

    off = "floor((price_initial-price_offre)/price_initial*100*100+0.5)/100"
    listings = select(LISTING, _STAR)
    cased = (
        "SELECT * EXCLUDE (price_initial, price_offre), coalesce(price_initial, price_offre) AS price_initial, "
        "CASE WHEN price_initial <> price_offre THEN price_offre END AS price_offre, "
        f"CASE WHEN price_initial <> price_offre AND price_initial > 0 AND price_offre <> 0 AND price_initial > price_offre THEN {off} "
        f"END AS discount_pct FROM ({listings})"
    )
    mad = "CASE WHEN currency = 'EUR' THEN floor({0}*10.85*100+0.5)/100 ELSE {0} END AS {0}_mad"
    unified = (
        f"SELECT *, {mad.format('price_initial')}, {mad.format('price_offre')}, "
        "CASE WHEN currency = 'EUR' THEN 10.85 END AS eur_to_mad_rate, title AS title_clean, "
        "concat(upper(substr(source, 1, 3)), '_', substr(md5(concat(lower(source), '|', link)), 1, 12)) AS id "
        f"FROM ({cased})"
    )
    return {
        "unified": unified,
        "listings": listings,
        "raw_listings": select({**LISTING, **RAW}, _STAR),
        "cards": select({**LISTING, **CARD}, _STAR),
        "products": select(PRODUCT, "part"),
        "offers": select(OFFER, "lineitem JOIN orders ON l_orderkey = o_orderkey"),
        "bids": "SELECT user_id AS negotiation, event_id, ts, value AS bid FROM events",
        "messages": select(MESSAGE, "conversations"),
        "audits": select(AUDIT, "events"),
    }
