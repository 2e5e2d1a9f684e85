"""Raw layer derived from the driver's TPC-H-ish tables.

The mart expects a TPC-DS-shaped raw layer (catalog_sales, web_sales,
inventory, date_dim, customer, ...). Here every raw table is a lazy Spark
plan over the given Parquet files, following the rules in FIXTURES.md, so
all work grows with the input and Catalyst prunes what a query does not use.

Fixture rules (moduli, offsets) are test-data design, not reference values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_mart.operators.common import CODE_TABLE_MAX_ROWS, small_side

# Julian day number of 1970-01-01: d_date_sk = JULIAN_EPOCH + days since epoch.
JULIAN_EPOCH = 2440588

# As-of dates of the three customer batches (SCD-2 fixtures).
CUSTOMER_BATCH_DATES = ["2001-01-01", "2001-02-01", "2001-03-01"]
NEW_CUSTOMER_OFFSET = 10 ** 9


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def date_sk(ts: Column) -> Column:
    return (F.lit(JULIAN_EPOCH) + F.unix_date(F.to_date(ts))).cast("bigint")


@dataclass
class RawTables:
    """Lazily derived raw tables for one scale-factor directory."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    # ---------------------------------------------------------------- input
    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def _memo(self, key: str, build) -> DataFrame:
        """One DataFrame object per derived dimension, so its bounded size
        check (operators.common.small_side) runs once per instance."""
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def _nation(self) -> DataFrame:
        return self._memo("nation", lambda: small_side(self.given("nation").select("n_nationkey", "n_name"),
                                                      CODE_TABLE_MAX_ROWS))

    # ------------------------------------------------------------ calendar
    def date_dim(self) -> DataFrame:
        """Every day of the calendar years spanned by the line items' ship dates.

        Size is bounded by the time span (366 rows per year), not by the data
        volume, which is what makes it safe to broadcast. It stands in for a
        stored calendar table, so it is derived once per instance and cached
        (a few KB; recomputed from lineage if an executor is lost).
        """
        if "date_dim" not in self._cache:
            self._cache["date_dim"] = self._derive_date_dim().cache()
        return self._cache["date_dim"]

    def _derive_date_dim(self) -> DataFrame:
        span = self.given("lineitem").agg(
            F.year(F.min("l_shipdate")).alias("y0"), F.year(F.max("l_shipdate")).alias("y1"))
        days = span.select(F.explode(F.sequence(
            F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))).alias("cal_dt"))
        return days.select(
            (F.lit(JULIAN_EPOCH) + F.unix_date("cal_dt")).cast("bigint").alias("d_date_sk"),
            F.col("cal_dt"),
            (F.dayofweek("cal_dt") - 1).cast("bigint").alias("day_of_wk_num"),
            # week 1 starts on Jan 1; later weeks start on Sunday (day 0)
            F.expr("(dayofyear(cal_dt) - 1 + dayofweek(make_date(year(cal_dt), 1, 1)) - 1) div 7 + 1")
            .cast("bigint").alias("wk_num"),
            F.month("cal_dt").cast("bigint").alias("mnth_num"),
            F.year("cal_dt").cast("bigint").alias("yr_num"),
        )

    # --------------------------------------------------------- sales feeds
    def _lines(self, catalog: bool, with_customer: bool) -> DataFrame:
        li = self.given("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
        li = li.filter(F.col("l_linenumber") <= 4) if catalog else li.filter(F.col("l_linenumber") > 4)
        if with_customer:
            orders = self.given("orders").select("o_orderkey", "o_custkey")
            li = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        return li

    def _sales(self, prefix: str, catalog: bool, with_customer: bool, extra_keys: bool) -> DataFrame:
        li = self._lines(catalog, with_customer)
        li = li.select("*",
                       F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("ec"),
                       F.col("l_quantity").cast("bigint").alias("q"),
                       F.round(F.col("l_discount") * 100).cast("bigint").alias("dp"))
        k = F.col("l_orderkey")
        q = F.col("q")
        sold = date_sk("l_shipdate")
        price_cents = F.expr("ec div (10 * q)")
        profit_cents = F.expr("ec * (100 - dp) div 1000 - 9000 * q")
        cols = [
            _null_when(k % 53 == 0, sold).alias(f"{prefix}_sold_date_sk"),
            F.col("l_partkey").cast("bigint").alias(f"{prefix}_item_sk"),
            _null_when(k % 37 == 0, F.col("l_suppkey").cast("bigint")).alias(f"{prefix}_warehouse_sk"),
            _null_when(k % 41 == 0, q).alias(f"{prefix}_quantity"),
            _null_when(k % 43 == 0, (price_cents.cast("decimal(18,0)") / 100).cast("decimal(12,2)"))
            .alias(f"{prefix}_sales_price"),
            _null_when(k % 47 == 0, (profit_cents.cast("decimal(18,0)") / 100).cast("decimal(12,2)"))
            .alias(f"{prefix}_net_profit"),
        ]
        if with_customer:
            cust = F.col("o_custkey").cast("bigint")
            nocust = F.col("o_orderkey") % 59 == 0
            if catalog:
                cols.append(_null_when(nocust, cust).alias("cs_ship_customer_sk"))
            else:
                cols.append(_null_when(nocust, cust).alias("ws_bill_customer_sk"))
        if extra_keys:
            if catalog:
                cust = F.col("o_custkey").cast("bigint")
                cols += [
                    (k % 1440).cast("bigint").alias("cs_sold_time_sk"),
                    (sold + F.col("l_linenumber")).cast("bigint").alias("cs_ship_date_sk"),
                    cust.alias("cs_bill_customer_sk"),
                    (cust % 50 + 1).alias("cs_bill_cdemo_sk"),
                    _null_when(cust % 23 == 0, cust % 20 + 1).alias("cs_bill_hdemo_sk"),
                    (cust % 25 + 1).alias("cs_bill_addr_sk"),
                    (cust % 50 + 1).alias("cs_ship_cdemo_sk"),
                    _null_when(cust % 23 == 0, cust % 20 + 1).alias("cs_ship_hdemo_sk"),
                    (k % 6 + 1).cast("bigint").alias("cs_call_center_sk"),
                    (k % 100 + 1).cast("bigint").alias("cs_catalog_page_sk"),
                    (k % 20 + 1).cast("bigint").alias("cs_ship_mode_sk"),
                    (k % 30 + 1).cast("bigint").alias("cs_promo_sk"),
                ]
            else:
                cols += [
                    (k % 60 + 1).cast("bigint").alias("ws_web_page_sk"),
                    (k % 12 + 1).cast("bigint").alias("ws_web_site_sk"),
                ]
        return li.select(*cols)

    def catalog_sales(self, with_customer: bool = False, extra_keys: bool = False) -> DataFrame:
        return self._sales("cs", True, with_customer or extra_keys, extra_keys)

    def web_sales(self, with_customer: bool = False, extra_keys: bool = False) -> DataFrame:
        return self._sales("ws", False, with_customer or extra_keys, extra_keys)

    # ----------------------------------------------------------- inventory
    def item(self) -> DataFrame:
        return self._memo("item", self._item)

    def _item(self) -> DataFrame:
        """One item per part."""
        return self.given("part").select(F.col("p_partkey").cast("bigint").alias("i_item_sk"),
                                         F.col("p_name").alias("i_product_name"), F.col("p_type").alias("i_item_desc"))

    def warehouse(self) -> DataFrame:
        return self._memo("warehouse", self._warehouse)

    def _warehouse(self) -> DataFrame:
        """One warehouse per supplier."""
        return self.given("supplier").select(F.col("s_suppkey").cast("bigint").alias("w_warehouse_sk")).distinct()

    def inventory(self) -> DataFrame:
        """Weekly stock counts of what a warehouse sells: each (part, supplier)
        pair on the Sunday of each week it ships in, some left out, and again
        on the Wednesday for every 20th part."""
        sk = date_sk("l_shipdate")
        pairs = self.given("lineitem").select(
            F.col("l_partkey").cast("bigint").alias("i"), F.col("l_suppkey").cast("bigint").alias("w"),
            (sk - (sk + 1) % 7).alias("sunday")).distinct()
        days = F.when(F.col("i") % 20 == 7, F.array(F.lit(0), F.lit(3))).otherwise(F.array(F.lit(0)))
        rows = (pairs.select("i", "w", "sunday", F.explode(days).alias("dow"))
                .select("i", "w", "dow", (F.col("sunday") + F.col("dow")).alias("d_date_sk")))
        wi = F.expr("d_date_sk div 7")
        keep = (F.col("dow") == 3) | ((F.col("i") + F.col("w") + wi) % 11 != 0)
        qty = ((F.col("i") * 31 + F.col("w") * 17 + wi * 7) % 60)
        qty = _null_when((F.col("i") * 31 + F.col("w") * 17 + wi) % 13 == 0, qty)
        return rows.filter(keep).select(
            F.col("d_date_sk").cast("int").alias("inv_date_sk"),
            F.col("i").cast("int").alias("inv_item_sk"),
            qty.cast("int").alias("inv_quantity_on_hand"),
            F.col("w").cast("int").alias("inv_warehouse_sk"),
        )

    # ------------------------------------------------------------ customer
    def customer(self, batch: int = 1) -> DataFrame:
        """Customer source table as delivered on batch 1, 2 or 3."""
        c = self.given("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        base = c.join(self._nation(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        if batch >= 2:
            base = base.filter(F.col("c_custkey") % 17 != 5)
            extra = (base.filter(F.col("c_custkey").isin(1, 2))
                     .withColumn("ident", F.col("c_custkey") + NEW_CUSTOMER_OFFSET))
            base = base.withColumn("ident", F.col("c_custkey")).unionByName(extra)
        else:
            base = base.withColumn("ident", F.col("c_custkey"))
        key = F.col("c_custkey")
        ident = F.col("ident")
        salutation = (F.when(key % 3 == 0, "Mr.").when(key % 3 == 1, "Ms.").otherwise("Dr."))
        salutation = _null_when(key % 31 == 0, salutation)
        last = F.col("c_name")
        hdemo = _null_when(key % 23 == 0, key % 20 + 1)
        if batch >= 2:
            changed = key % 10 == 3
            if batch >= 3:
                changed = changed & (key % 20 != 3)
            last = F.when(changed, F.concat(last, F.lit("-x"))).otherwise(last)
            hdemo = F.when((key % 23 == 0) & (key % 10 == 4), F.lit(0)).otherwise(hdemo)
        if batch >= 3:
            salutation = F.when(key % 31 == 0, F.lit("Mr.")).otherwise(salutation)
        return base.select(
            salutation.alias("c_salutation"),
            F.when(key % 2 == 0, "Y").otherwise("N").alias("c_preferred_cust_flag"),
            _null_when(key % 19 == 0, key % 365 + 2449719).cast("bigint").alias("c_first_sales_date_sk"),
            ident.cast("bigint").alias("c_customer_sk"),
            F.lit("").alias("c_login"),
            (key % 50 + 1).cast("bigint").alias("c_current_cdemo_sk"),
            F.col("c_mktsegment").alias("c_first_name"),
            hdemo.cast("bigint").alias("c_current_hdemo_sk"),
            _null_when(key % 29 == 0, F.col("c_nationkey") + 1).cast("bigint").alias("c_current_addr_sk"),
            last.alias("c_last_name"),
            F.concat(F.lit("C"), ident.cast("string")).alias("c_customer_id"),
            _null_when(key % 7 == 0, key % 100 + 2451000).cast("bigint").alias("c_last_review_date_sk"),
            (key % 12 + 1).cast("bigint").alias("c_birth_month"),
            F.col("n_name").alias("c_birth_country"),
            (key % 60 + 1940).cast("bigint").alias("c_birth_year"),
            (key % 28 + 1).cast("bigint").alias("c_birth_day"),
            F.concat(F.lower("c_mktsegment"), ident.cast("string"), F.lit("@example.com")).alias("c_email_address"),
            _null_when(key % 7 == 0, key % 365 + 2449750).cast("bigint").alias("c_first_shipto_date_sk"),
        )

    def customer_address(self) -> DataFrame:
        return self._memo("customer_address", self._customer_address)

    def _customer_address(self) -> DataFrame:
        n = self.given("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.given("region").select("r_regionkey", "r_name")
        a = n.join(small_side(r, CODE_TABLE_MAX_ROWS), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        sk = (F.col("n_nationkey") + 1).cast("bigint")
        return a.select(
            sk.alias("ca_address_sk"),
            F.concat(F.lit("Street "), sk.cast("string")).alias("ca_street_name"),
            F.concat(F.lit("Suite "), (sk * 10).cast("string")).alias("ca_suite_number"),
            F.col("r_name").alias("ca_state"),
            F.when(sk % 3 == 0, "apartment").when(sk % 3 == 1, "condo").otherwise("single family")
            .alias("ca_location_type"),
            F.col("n_name").alias("ca_country"),
            F.concat(F.lit("A"), sk.cast("string")).alias("ca_address_id"),
            F.concat(F.col("n_name"), F.lit(" County")).alias("ca_county"),
            (sk * 7 % 1000).cast("string").alias("ca_street_number"),
            F.lpad((sk * 1231 % 100000).cast("string"), 5, "0").alias("ca_zip"),
            F.concat(F.lit("City "), sk.cast("string")).alias("ca_city"),
            (-(sk % 6) - 5).cast("double").alias("ca_gmt_offset"),
        )

    def customer_demographics(self) -> DataFrame:
        return self._memo("customer_demographics", self._customer_demographics)

    def _customer_demographics(self) -> DataFrame:
        """Demographic profiles 1..49 (profile 50, used by customers, dangles)."""
        keys = (self.given("customer").select((F.col("c_custkey") % 50 + 1).cast("bigint").alias("k"))
                .distinct().filter(F.col("k") < 50))
        k = F.col("k")
        return keys.select(
            k.alias("cd_demo_sk"),
            F.when(k % 2 == 0, "M").otherwise("F").alias("cd_gender"),
            F.element_at(F.array(*[F.lit(x) for x in ["M", "S", "D", "W", "U"]]), (k % 5 + 1).cast("int"))
            .alias("cd_marital_status"),
            F.element_at(F.array(*[F.lit(x) for x in ["Primary", "Secondary", "College", "2 yr Degree",
                                                      "4 yr Degree", "Advanced Degree", "Unknown"]]),
                         (k % 7 + 1).cast("int")).alias("cd_education_status"),
            (k % 20 * 500 + 500).cast("bigint").alias("cd_purchase_estimate"),
            F.element_at(F.array(*[F.lit(x) for x in ["Good", "Low Risk", "High Risk", "Unknown"]]),
                         (k % 4 + 1).cast("int")).alias("cd_credit_rating"),
            (k % 7).cast("bigint").alias("cd_dep_count"),
            (k % 5).cast("bigint").alias("cd_dep_employed_count"),
            (k % 3).cast("bigint").alias("cd_dep_college_count"),
        )

    def household_demographics(self) -> DataFrame:
        return self._memo("household_demographics", self._household_demographics)

    def _household_demographics(self) -> DataFrame:
        keys = (self.given("customer").select((F.col("c_custkey") % 20 + 1).cast("bigint").alias("k"))
                .distinct())
        k = F.col("k")
        return keys.select(
            k.alias("hd_demo_sk"),
            (k % 5 + 1).cast("bigint").alias("hd_income_band_sk"),
            F.element_at(F.array(*[F.lit(x) for x in ["0-500", "501-1000", "1001-5000", "5001-10000",
                                                      ">10000", "Unknown"]]), (k % 6 + 1).cast("int"))
            .alias("hd_buy_potential"),
            (k % 10).cast("bigint").alias("hd_dep_count"),
            (k % 5).cast("bigint").alias("hd_vehicle_count"),
        )

    def income_band(self) -> DataFrame:
        return self._memo("income_band", self._income_band)

    def _income_band(self) -> DataFrame:
        keys = self.household_demographics().select(F.col("hd_income_band_sk").alias("k")).distinct()
        k = F.col("k")
        return keys.select(
            k.alias("ib_income_band_sk"),
            ((k - 1) * 10000 + 1).cast("bigint").alias("ib_lower_bound"),
            (k * 10000).cast("bigint").alias("ib_upper_bound"),
        )

    # ------------------------------------------------- key-only dimensions
    def key_dim(self, name: str) -> DataFrame:
        """Key-only dimensions referenced by the sales foreign keys."""
        spec = KEY_DIMS[name]
        lo, hi, col = spec
        return self.spark.range(lo, hi + 1).select(F.col("id").cast("bigint").alias(col))


# name -> (first key, last key, key column); a fact key outside dangles.
KEY_DIMS = {
    "time_dim": (0, 1439, "t_time_sk"),
    "call_center": (1, 5, "cc_call_center_sk"),
    "catalog_page": (1, 100, "cp_catalog_page_sk"),
    "ship_mode": (1, 20, "sm_ship_mode_sk"),
    "promotion": (1, 29, "p_promo_sk"),
    "web_page": (1, 60, "wp_web_page_sk"),
    "web_site": (1, 12, "web_site_sk"),
}
