from pyspark.sql import functions as F

from loamwork.functions import names as N
from loamwork.functions import text as T
from loamwork.operators.ordering import with_global_index


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_repairs(spark):
    assert value(spark, T.fix_split_words, "environ-\nment") == "environment"
    assert value(spark, T.fill_empty_cells, "A |  | C") == "A | N/A | C"
    assert value(spark, T.fix_mashed_words, "tCO2e FY24 kWh") == "t CO 2 e FY 24 k Wh"
    assert value(spark, T.clean_text, None) is None


def test_cleaning_by_hand(spark):
    assert value(spark, T.remove_noise, "a\u200bb\x0cc\n***\n\n----- x\n\u00e9\n") == "ab\nc\n\n x\n\u00e9\n"
    assert value(spark, T.collapse_space, " a \t b  c \n  x |  y  \n\n\n\nz") == "a b c\nx |  y\n\nz"
    assert value(spark, T.replace_typography, "\u2014\u2022\u25cb\u00a9\u2033") == '--\u2022o(C)"'
    assert value(spark, T.merge_broken_lines, "one\ntwo\nthree\nfour.\nfive\n\nsix") == "one two\nthree four.\nfive\n\nsix"
    assert value(spark, T.merge_broken_lines, "x" * 79 + "\na\n" + "x" * 80 + "\nb") == "x" * 79 + " a\n" + "x" * 80 + "\nb"
    assert value(spark, T.fix_reversed, "latoT | ok\n,eman") == "Total | ok\nname,"
    assert value(spark, T.clean_text, "KeyFY24\nenviron-\nment\n|a||\n") == "Key FY 24 environment\nN/A | a | N/A | N/A\n"
    assert value(spark, T.printable_ratio, " \n\u00a0") == 1.0


def test_headings_by_hand(spark):
    def heading(line, before=None, after=None):
        row = spark.createDataFrame([(line, before, after)], "a string, b string, c string")
        h = row.select(T.heading(F.col("a"), F.col("b"), F.col("c")).alias("h")).first().h
        return h.confidence, h.level if h.confidence >= 50 else 0

    long = "word " * 16
    assert heading("BUSINESS OVERVIEW") == (95, 1)  # upper, titled, phrase
    assert heading("Business Overview") == (55, 2)
    assert heading("OVERVIEW") == (25, 0)  # one word is neither upper nor titled
    assert heading("1. Growth Strategy:", "x", long) == (85, 2)  # two of three words begin in upper case, too few
    assert heading("the outlook for next year", " ", long) == (60, 2) and heading("the outlook for next year", "", long) == (45, 0)
    assert heading("Page 12 Risk Overview") == (0, 0) and heading("12") == (0, 0) and heading("ab") == (0, 0)
    assert heading("Key Results Of The Year For All Business Segments In The Group") == (55, 3)


def test_names(spark):
    assert value(spark, T.clean_company_name, "X Private Limited") == "X Private"
    assert value(spark, T.clean_company_name, " X Limited Ltd. ") == "X" and value(spark, T.clean_company_name, None) == ""
    assert value(spark, T.safe_file_name, "Reliance Industries Ltd.") == "Reliance_Industries_Ltd"
    assert value(spark, T.safe_file_name, "Tata Steel/TCS") == "Tata_Steel_TCS" and value(spark, T.safe_file_name, "Company   Name") == "Company_Name"
    assert value(spark, T.safe_file_name, "Test <Company> Name?") == "Test_Company_Name" and value(spark, T.safe_file_name, "") == "Unknown" and value(spark, T.safe_file_name, "a:b\\c") == "a_b_c"
    assert value(spark, T.category_by_hits, "zzz") == "Environmental (E)" and value(spark, T.category_by_hits, "wage, board, human rights") == "Social (S)"
    assert value(spark, T.category_by_order, "zzz") == "Governance (G)" and value(spark, T.category_by_order, "carbon") == "Governance (G)"


def test_file_names_by_hand(spark):
    row = spark.createDataFrame([("{SERIAL}_{symbol}_2020_2021.pdf", "2023-24", "TCS", 3), ("A 2020-21 x 2019-20", "2023-24", "T", None), ("B{year}_2020_21", "2024-25", "", 1)], "c string, y string, s string, n int")
    got = [r.n for r in row.select(N.convention_name(F.col("c"), F.col("y"), F.col("s"), F.col("n")).alias("n")).collect()]
    assert got == ["3_TCS_2023_2024", "A 2023-24 x 2019-20", "B2024-25_2024_25"]
    parsed = lambda x: value(spark, N.parsed_name, x)
    assert tuple(parsed("Reliance_Industries_BRSR_2022-23.pdf")) == ("Reliance Industries", "2022-23", True, False, False, "unknown")
    assert tuple(parsed("d/Tata_Steel_BRSR_2023-24_from_AnnualReport.docx")) == ("Tata Steel", "2023-24", False, True, False, "unknown")
    assert tuple(parsed("TCS_AnnualReport_2024-25.pdf")) == ("TCS", "2024-25", False, False, False, "annual_report") and parsed("TCS.pdf") is None
    assert parsed("R_BRSR_2022-23_metadata.json").file_type == "metadata"
    assert tuple(value(spark, N.company_and_year, "data/Tata-Steel/2022/r.pdf")) == ("Tata Steel", "2022") and tuple(value(spark, N.company_and_year, "data/A_B/r_2019.pdf")) == ("A B", "2019")
    assert value(spark, lambda c: N.symbol_in_name(c, F.array(F.lit("AB"), F.lit("TCS"))), "tcs_AB.pdf") == "TCS"


def test_file_size_and_years(spark):
    assert value(spark, lambda c: T.file_size(c.cast("long")), "1536") == "1.50 KB"
    assert value(spark, lambda c: F.struct(*T.fiscal_years(c)), "2023-24") == (2023, 2024)


def test_global_index(spark):
    rows = spark.createDataFrame([("a", k % 7) for k in range(100)], "g string, k int")
    out = with_global_index(rows, ["g", "k"]).orderBy("idx").collect()
    assert [r.idx for r in out] == [*range(100)] and [r.k for r in out] == sorted(k % 7 for k in range(100))
    assert with_global_index(rows.limit(0), ["k"]).count() == 0
