"""Provinces by code, short code, source code, alias or name (PRJ-19), and the rows of their dimension (BIZ-7)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators.references import bounded

# Region; then of each province the statistical code, the short code, the source's code and the name.
PROVINCES = """
Đồng bằng sông Hồng
01 HNI 101 Thành phố Hà Nội
16 VPH 219 Tỉnh Vĩnh Phúc
27 BNH 223 Tỉnh Bắc Ninh
30 HDG 107 Tỉnh Hải Dương
31 HPG 103 Thành phố Hải Phòng
33 HYN 109 Tỉnh Hưng Yên
34 TBH 115 Tỉnh Thái Bình
35 HNM 111 Tỉnh Hà Nam
36 NDH 113 Tỉnh Nam Định
37 NBH 117 Tỉnh Ninh Bình
22 QNH 225 Tỉnh Quảng Ninh
Trung du và miền núi phía Bắc
02 HGG 201 Tỉnh Hà Giang
04 CBG 203 Tỉnh Cao Bằng
06 BKN 207 Tỉnh Bắc Kạn
08 TQG 211 Tỉnh Tuyên Quang
10 LCI 205 Tỉnh Lào Cai
11 DBN 301 Tỉnh Điện Biên
12 LCH 302 Tỉnh Lai Châu
14 SLA 303 Tỉnh Sơn La
15 YBN 213 Tỉnh Yên Bái
17 HBH 305 Tỉnh Hòa Bình
19 TNN 215 Tỉnh Thái Nguyên
20 LSON 209 Tỉnh Lạng Sơn
24 BGG 221 Tỉnh Bắc Giang
25 PTO 217 Tỉnh Phú Thọ
Bắc Trung Bộ và Duyên hải miền Trung
38 THA 401 Tỉnh Thanh Hóa
40 NAN 403 Tỉnh Nghệ An
42 HTH 405 Tỉnh Hà Tĩnh
44 QBH 407 Tỉnh Quảng Bình
45 QTI 409 Tỉnh Quảng Trị
46 TTH 411 Tỉnh Thừa Thiên Huế
48 DNG 501 Thành phố Đà Nẵng
49 QNM 503 Tỉnh Quảng Nam
51 QNI 505 Tỉnh Quảng Ngãi
52 BDH 507 Tỉnh Bình Định
54 PYN 509 Tỉnh Phú Yên
56 KHA 511 Tỉnh Khánh Hòa
58 NTH 705 Tỉnh Ninh Thuận
60 BTH 715 Tỉnh Bình Thuận
Tây Nguyên
62 KTM 601 Tỉnh Kon Tum
64 GLI 603 Tỉnh Gia Lai
66 DLC 605 Tỉnh Đắk Lắk
67 DKN 606 Tỉnh Đắk Nông
68 LDG 703 Tỉnh Lâm Đồng
Đông Nam Bộ
79 HCM 701 Thành phố Hồ Chí Minh
70 BPC 707 Tỉnh Bình Phước
72 TNH 709 Tỉnh Tây Ninh
74 BDG 711 Tỉnh Bình Dương
75 DNI 713 Tỉnh Đồng Nai
77 VTU 717 Tỉnh Bà Rịa - Vũng Tàu
Đồng bằng sông Cửu Long
80 LAN 801 Tỉnh Long An
82 TGG 807 Tỉnh Tiền Giang
83 BTE 811 Tỉnh Bến Tre
84 TVH 817 Tỉnh Trà Vinh
86 VLG 809 Tỉnh Vĩnh Long
87 DTH 803 Tỉnh Đồng Tháp
89 AGG 805 Tỉnh An Giang
91 KGG 813 Tỉnh Kiên Giang
92 CTO 815 Thành phố Cần Thơ
93 HGG2 816 Tỉnh Hậu Giang
94 STG 819 Tỉnh Sóc Trăng
95 BLU 821 Tỉnh Bạc Liêu
96 CMU 823 Tỉnh Cà Mau
"""
# Other names, by statistical code.
ALIASES = {"01": ["HN", "TPHN", "HA NOI"], "79": ["TPHCM", "TP HCM", "SAI GON", "HO CHI MINH"], "48": ["DN", "DA NANG"], "31": ["HP", "HAI PHONG"], "92": ["CT", "CAN THO"], "77": ["BRVT", "BA RIA VUNG TAU"], "46": ["THUA THIEN HUE", "HUE"]}
# Codes of no single province.
NATIONWIDE, NOWHERE = ["824"], ["825", "999", "UNKNOWN"]
MULTI_KEY, UNKNOWN_KEY = "GEO_MULTI_UNALLOCATED", "GEO_UNKNOWN"
SPECIAL_NAMES = {MULTI_KEY: ("Đa địa bàn chưa phân bổ", "Đa vùng"), UNKNOWN_KEY: ("Chưa xác định", "Chưa xác định")}
# Words before a name that don't count.
BEFORE_NAMES = r"^(tinh|thanh pho|tp\.?|t\.)\s+"
# End of the fixed values.

PROVINCE = "gso_code string, short_code string, source_code string, province_name string, region_name string"


def provinces(spark: SparkSession) -> DataFrame:
    """The known provinces, one row each."""
    rows, region = [], None
    for line in PROVINCES.strip().splitlines():
        if line[:2].isdigit():
            rows.append((*line.split(" ", 3), region))
        else:
            region = line
    return spark.createDataFrame(rows, PROVINCE)


def plain_letters() -> tuple[str, str]:
    """Letters with marks that have a plain Latin letter under them, and that letter, by the rule of decomposition."""
    found = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x1F00) if unicodedata.normalize("NFD", chr(c))[0].isascii() and unicodedata.normalize("NFD", chr(c)) != chr(c)]
    return "".join(a for a, _ in found) + "đĐ", "".join(b for _, b in found) + "dD"


def name_key(c: Column) -> Column:
    """A name in plain lower-case letters and digits, without the word for what kind of place it is."""
    plain = F.regexp_replace(F.translate(c, *plain_letters()), r"\p{Mn}", "")
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(plain)), BEFORE_NAMES, ""), "[^a-z0-9]", "")


def province_keys(table: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(tier, key, gso_code, n): what leads to a province in each tier; ``n`` over 1 where a key leads to several in its tier. ``aliases`` has alias and gso_code.

    Tier 1: codes, with and without their leading zero, short codes, source codes, aliases. Tier 2: names and aliases as names."""
    code = lambda c, tier=1: table.select(F.lit(tier).alias("tier"), c.alias("key"), "gso_code")
    out = [code(F.col("gso_code")), code(F.col("gso_code").cast("int").cast("string")), code(F.upper("short_code")), code(F.col("source_code")), code(name_key(F.col("province_name")), 2)]
    if aliases is not None:
        out += [aliases.select(F.lit(1).alias("tier"), F.upper("alias").alias("key"), "gso_code"), aliases.select(F.lit(2).alias("tier"), name_key(F.col("alias")).alias("key"), "gso_code")]
    every = out[0]
    for one in out[1:]:
        every = every.unionByName(one)
    return every.filter("key is not null and key <> ''").distinct().groupBy("tier", "key").agg(F.min("gso_code").alias("gso_code"), F.count("*").alias("n"))


def aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, gso) for gso, of in ALIASES.items() for a in of], "alias string, gso_code string")


def normalise(df: DataFrame, column: str, keys: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    """PRJ-19: ``df`` with ``gso_code``, ``short_code``, ``province_name``, ``region_name``, ``geography_key`` and ``province_state`` of the code or name in ``column``.

    The first tier that knows the value decides: codes and aliases, then names, then numbers with their zeros filled up. A key that leads to several provinces there is ``ambiguous`` and has none;
    others are ``resolved``, ``special`` (the whole country, or none) or ``unknown``; blank values are ``blank``. Distinct values are resolved once and joined back, so a hot value costs one lookup."""
    spark = df.sparkSession
    table = table if table is not None else provinces(spark)
    keys = keys if keys is not None else province_keys(table, aliases(spark))
    value = F.trim(F.col(column).cast("string"))
    values = df.select(F.col(column).cast("string").alias("_v")).filter("_v is not null and trim(_v) <> ''").distinct().withColumn("_t", F.trim("_v"))
    tries = F.array(F.struct(F.lit(1).alias("order"), F.lit(1).alias("tier"), F.upper("_t").alias("key")), F.struct(F.lit(2).alias("order"), F.lit(2).alias("tier"), name_key(F.col("_t")).alias("key")), F.struct(F.lit(3).alias("order"), F.lit(1).alias("tier"), F.when(F.col("_t").rlike("^[0-9]$"), F.lpad("_t", 2, "0")).alias("key")))
    found = values.select("_v", F.explode(tries).alias("x")).select("_v", "x.*").join(bounded(keys), ["tier", "key"])
    found = found.groupBy("_v").agg(F.min_by(F.struct("gso_code", "n"), "order").alias("f")).select("_v", F.when(F.col("f.n") == 1, F.col("f.gso_code")).alias("gso_code"), (F.col("f.n") > 1).alias("_several"))
    found = found.join(bounded(table.select("gso_code", "short_code", "province_name", "region_name")), "gso_code", "left")
    rows = df.join(bounded(found), F.col(column).cast("string") == F.col("_v"), "left").drop("_v")
    upper = F.upper(value)
    special = F.when(upper.isin(NATIONWIDE), MULTI_KEY).when(upper.isin(NOWHERE), UNKNOWN_KEY)
    state = F.when(F.coalesce(value, F.lit("")) == "", "blank").when(F.col("gso_code").isNotNull(), "resolved").when(F.col("_several"), "ambiguous").when(special.isNotNull(), "special").otherwise("unknown")
    key = F.coalesce(F.concat(F.lit("GEO_"), F.col("short_code")), F.when(~F.coalesce(F.col("_several"), F.lit(False)), special))
    return rows.withColumns({"geography_key": key, "province_state": state}).drop("_several")


def dimension_rows(spark: SparkSession, version: str = "v1") -> DataFrame:
    """BIZ-7: the canonical rows of the dimension of places: each province, all places together, none."""
    known = provinces(spark).select(F.concat(F.lit("GEO_"), "short_code").alias("geography_key"), F.lit(version).alias("geography_version"), F.col("short_code").alias("province_code"), "province_name", "region_name", F.lit(False).alias("is_multi_geography"), F.lit(False).alias("is_unknown"))
    return known.unionByName(spark.createDataFrame([(k, version, None, *SPECIAL_NAMES[k], k == MULTI_KEY, k == UNKNOWN_KEY) for k in (MULTI_KEY, UNKNOWN_KEY)], known.schema))
