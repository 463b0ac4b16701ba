"""A roll made from the customer and nation tables, by integer arithmetic on keys that any SQL engine evaluates alike.

The test tables hold no Devanagari. Names are picked from short lists that include twins, damaged spellings, fragments
and foreign characters on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN = (
    "राम शाम रमेश सुरेश महेश गणेश दिनेश नरेश शीतल शितल किरण किंरण हणमंत हनुमंत पोर्णिमा पूर्णिमा सुनीता सुनिता अनिता अनित्ता अनित्रा माधुरी माथुरी "
    "संगीता सांगेता संजीव संजीच राजीच मोहन मोहून शौकत्त शौकत यशवंत्त जयवंत्त हणमंत्त अनित्त सखाराध जगन्नाध बाळाण्या आण्पा बाणप्पा माण्णा रामं भीमा भींमा "
    "युनुस चूनुस जवकुमार जयकुमार क् रा ीराम रामक् प्पा ़राम चाँद ज़किर प्रकाश मनीषा सुरेखा लता गीता सीता मीता नीता रीता विमल कमल अमल निर्मल "
    "रोहित मोहित सोहित रोहन सोहन नावेद अजिंत अजित रॉफेक जुयेर शशिक्तांत निल्लास बाळू काळू साळू"
).split()
MIDDLE = "चंद्रकांत शंकर बाबू दत्तात्रय विठ्ठल पांडुरंग तुकाराम ज्ञानेश्वर मारुती बाळासाहेब आण्णा किसन लक्ष्मण".split()
SURNAME = "पाटील जाधव चोपडे पिसाळ मोरे शिंदे पवार कदम भोसले माने साळुंखे यादव कांबळे शेख मुल्ला सूर्यवंशी गायकवाड".split()
#: Consecutive customers of a nation's file: over 25 nations and 6 pages some 30 cards a page, whatever the scale.
PER_FILE = 4500
LABEL = ("नाव : ", "नाच : ", "नांव : ", "नाव: ", "नाब : ", "नाव ; ", "नाव  :", "नाव : - ")
RELATION = ("पतीचे नाव: ", "वडिलांचे नाव : ", "आईचे नाव: ", "पत्नीचे नाव: ", "यडिलांचे नाव: ", "पत्तीचे नाव : ", "नाव; ")


def _pick(items, index: str, spark: bool) -> str:
    inside = ", ".join(f"'{x}'" for x in items)
    return f"element_at(array({inside}), CAST({index} AS INT))" if spark else f"list_value({inside})[{index}]"


def people_sql(spark: bool) -> str:
    """id, pdf_file, page_num, given, middle, surname, full_name of each customer."""
    given = _pick(GIVEN, f"(k * 13 + k % 7) % {len(GIVEN)} + 1", spark)
    middle = _pick(MIDDLE, f"(k * 7 + 3) % {len(MIDDLE)} + 1", spark)
    surname = _pick(SURNAME, f"(k * 11 + 5) % {len(SURNAME)} + 1", spark)
    text = "STRING" if spark else "VARCHAR"
    return f"""
SELECT k AS id, 'roll_' || n_name || '_' || CAST(CAST((k - k % {PER_FILE}) / {PER_FILE} AS BIGINT) AS {text}) AS pdf_file, CAST(3 + k % 6 AS INT) AS page_num, given, middle, surname,
  CASE WHEN k % 41 = 0 THEN 'अब' WHEN k % 37 = 0 THEN 'राम५ ' || surname WHEN k % 31 = 0 THEN 'John Smith ' || surname
    WHEN k % 29 = 0 THEN given || ' उर्फ ' || middle || ' ' || surname WHEN k % 23 = 0 THEN middle || 'च्या ' || surname
    WHEN k % 19 = 0 THEN given || 'ः, ' || surname WHEN k % 17 = 0 THEN given || '@' || surname
    WHEN k % 13 = 0 THEN 'महाराष्ट्र ' || surname WHEN k % 4 = 0 THEN given WHEN k % 4 = 1 THEN given || ' ' || surname
    WHEN k % 4 = 2 THEN given || ' ' || middle || '  ' || surname ELSE given || ' ' || middle || ' ' || surname || ' देव' END AS full_name
FROM (SELECT k, n_name, {given} AS given, {middle} AS middle, {surname} AS surname
      FROM (SELECT c_custkey AS k, c_nationkey FROM customer) c JOIN nation ON c_nationkey = n_nationkey) x"""


def cards_sql(spark: bool, people: str = "people") -> str:
    """pdf_file, page_num, id, card."""
    serial = "CAST(id % 999 + 1 AS STRING)" if spark else "CAST(id % 999 + 1 AS VARCHAR)"
    text = "STRING" if spark else "VARCHAR"
    label, relation = _pick(LABEL, f"id % {len(LABEL)} + 1", spark), _pick(RELATION, f"id % {len(RELATION)} + 1", spark)
    return f"""
SELECT pdf_file, page_num, id, CASE WHEN id % 11 = 0 THEN translate({serial}, '0123456789', '०१२३४५६७८९') ELSE {serial} END || chr(10)
  || 'ABC' || lpad(CAST(id AS {text}), 7, '0') || chr(10) || {label} || full_name
  || CASE WHEN id % 5 = 0 THEN ' ' ELSE chr(10) END || {relation} || middle || ' ' || surname || chr(10)
  || 'घर क्रमांक : ' || CAST(id % 90 AS {text}) || chr(10) || 'वय : ' || CAST(20 + id % 60 AS {text}) || ' लिंग : '
  || CASE WHEN id % 2 = 0 THEN 'पुरुष' ELSE 'महिला' END AS card
FROM {people}"""


HEADER = "विधानसभा मतदारसंघ २८२"
#: Pages without text: of every fifth nation one, null or empty.
BLANK_SQL = "SELECT 'roll_' || n_name || '_0' AS pdf_file, CAST(9 AS INT) AS page_num, CASE WHEN n_nationkey % 2 = 0 THEN '' END AS text FROM nation WHERE n_nationkey % 5 = 0"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation")}


def _sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(query.replace("FROM customer", "FROM {customer}").replace("JOIN nation", "JOIN {nation}").replace("FROM nation", "FROM {nation}").replace("FROM people", "FROM {people}"), **tables)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, people_sql(True), **_tables(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pdf_file, page_num, text."""
    cards = _sql(spark, cards_sql(True), people=people(spark, sf_dir))
    # Dealt out by number, which is not merged again: a page is few bytes but much work.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    made = cards.repartition(n, "pdf_file", "page_num").groupBy("pdf_file", "page_num").agg(F.array_sort(F.collect_list(F.struct("id", "card"))).alias("cards"))
    text = F.concat_ws("\n", F.lit(HEADER), F.array_join("cards.card", "\n"))
    return made.select("pdf_file", "page_num", text.alias("text")).unionByName(_sql(spark, BLANK_SQL, nation=_tables(spark, sf_dir)["nation"]))


def duck_ctes() -> str:
    """people, cards and roll as common table expressions for DuckDB."""
    return f"""people AS ({people_sql(False)}),
cards AS ({cards_sql(False)}),
roll AS (SELECT pdf_file, page_num, '{HEADER}' || chr(10) || string_agg(card, chr(10) ORDER BY id) AS text FROM cards GROUP BY pdf_file, page_num
  UNION ALL {BLANK_SQL})"""
