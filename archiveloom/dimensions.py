"""Fixed reference values of the research archive and their DataFrame forms.

Everything here is small by nature (at most 87 rows), so the DataFrame forms are
safe to broadcast whatever the size of the archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# enumerations
# ---------------------------------------------------------------------------
PROJECT_TYPES = ("QDA_PROJECT", "QD_PROJECT", "OTHER_PROJECT", "NOT_A_PROJECT")
DOWNLOAD_METHODS = ("SCRAPING", "API-CALL")
DOWNLOAD_RESULTS = (
    "SUCCEEDED",
    "FAILED_SERVER_UNRESPONSIVE",
    "FAILED_LOGIN_REQUIRED",
    "FAILED_TOO_LARGE",
)
PERSON_ROLES = ("UPLOADER", "AUTHOR", "OWNER", "OTHER", "UNKNOWN")

# Spellings of the API download method that are normalised
API_METHOD_SPELLINGS = ("API", "api", "SCRAPING | API")

# Project type -> label of the per-repository reports, in report order
TYPE_LABELS = (
    ("QDA_PROJECT", "QDA"),
    ("QD_PROJECT", "QD"),
    ("OTHER_PROJECT", "Other project"),
    ("NOT_A_PROJECT", "No project"),
)
# Report scopes restricted to one project type
REPORT_SCOPES = (("qda", "QDA_PROJECT"), ("qd", "QD_PROJECT"))

UNCLASSIFIED = "UNCLASSIFIED"
NO_PROJECT_LABEL = "No project"
FALLBACK_REPOSITORY_ID = 17
IMPUTED_DOWNLOAD_DATE = "2026-04-17T00:00:00.000000+00:00"

# ---------------------------------------------------------------------------
# File extensions per qualitative-analysis tool
# ---------------------------------------------------------------------------
QDA_TOOL_EXTENSIONS = {
    "Quirkos": ("qpd", "qrk"),
    "f4analyse": ("f4p",),
    "QDA Miner": ("ppj", "pprj", "qlt", "qdp", "wpj"),
    "QDAcity": ("qdpx", "qdc"),
    "Dedoose": (),
    "ATLAS.ti": ("atlasproj", "hpr7", "atlproj", "atlpac", "hpr6", "hprx", "hprm"),
    "RQDA": ("rqda",),
    "Transana": ("tra",),
    "QualCoder": ("qda",),
    "HyperRESEARCH": ("hs4", "hs2", "hs4z", "hsz"),
    "NVivo": ("nvp", "nvpx"),
    "MaxQDA": (
        "mqda", "mqbac", "mqtc", "mqex", "mqmtr", "mx24", "mx24bac", "mc24", "mex24",
        "mx22", "mx20", "mx18", "mx12", "mx11", "mx5", "mx4", "mx3", "mx2", "m2k", "loa",
        "sea", "mtr", "mod", "mex22",
    ),
    "REFI-QDA (Standard)": ("qdpx", "qdc"),
}
QDA_EXTENSIONS = tuple(sorted({e for exts in QDA_TOOL_EXTENSIONS.values() for e in exts}))

# Primary research data (documents, audio, video)
PRIMARY_DATA_EXTENSIONS = (
    "docx", "doc", "txt", "pdf", "rtf",
    "mp3", "wav", "m4a", "aac", "flac", "ogg", "wma",
    "mp4", "mov", "avi", "mkv", "wmv", "webm",
)
# Files that never count as content
JUNK_FILE_NAMES = (".ds_store", "thumbs.db", "desktop.ini")
JUNK_EXTENSIONS = ("tmp", "log", "lock", "ds_store")

# File types not fetched at acquisition time
IGNORED_FILE_TYPES = (
    "mp4", "mov", "avi", "mkv", "wmv", "flv", "m4v", "webm",
    "mp3", "wav", "aac", "flac", "ogg", "wma", "m4a", "mpg", "m2ts",
    "fits", "hdf5", "h5", "nc", "grib", "mat", "sav", "dta",
    "zip", "rar", "7z", "tar", "gz", "bz2",
    "exe", "dll", "so", "bin", "dat",
)
# The two entries above that the strict-compatibility list fuses
FUSED_IGNORED_TYPES = ("m2ts", "fits")

# ---------------------------------------------------------------------------
# Repositories, by id
# ---------------------------------------------------------------------------
REPOSITORY_LABELS = (
    (1, "zenodo"),
    (2, "dryad"),
    (3, "uk-data-service"),
    (4, "syracuse-qualitative-data-repository"),
    (5, "dans"),
    (6, "dataverse-no"),
    (7, "ada"),
    (8, "sada"),
    (9, "hihsn"),
    (10, "harvard-dataverse"),
    (11, "finnish-social-science-data-archive"),
    (12, "aussda"),
    (13, "cessda"),
    (14, "databray"),
    (15, "icpsr"),
    (16, "open-data-uni-halle"),
    (17, "N/A"),
    (18, "harvard-murray-archive"),
    (19, "columbia-oral-history-archive"),
    (20, "sikt"),
)

# Sections of the written report, in order (title, slug)
REPORT_SECTIONS = (
    ("Zenodo", "zenodo"),
    ("Harvard Dataverse", "harvard-dataverse"),
    ("DANS", "dans"),
    ("Dryad", "dryad"),
    ("Open Data Uni Halle", "open-data-uni-halle"),
    ("Finnish Social Science Data Archive", "finnish-social-science-data-archive"),
    ("UK Data Service", "uk-data-service"),
    ("Syracuse Qualitative Data Repository", "syracuse-qualitative-data-repository"),
    ("SIKT", "sikt"),
    ("CESSDA", "cessda"),
    ("ICPSR", "icpsr"),
    ("ADA", "ada"),
    ("Harvard Murray Archive", "harvard-murray-archive"),
    ("DataverseNO", "dataverse-no"),
    ("Columbia Oral History Archive", "columbia-oral-history-archive"),
    ("HIHSN", "hihsn"),
    ("SADA", "sada"),
    ("N/A", "n-a"),
    ("AUSSDA", "aussda"),
)

# ---------------------------------------------------------------------------
# Search terms of the acquisition, one per line
# ---------------------------------------------------------------------------
QUERY_TERMS = (
    "personality interviews",
    "life experiences",
    "attitudes and perceptions",
    "beliefs and values",
    "psychological interviews",
    "case study qualitative",
    "semi-structured interviews",
    "in-depth interviews",
    "narrative interviews",
    "oral histories",
    "life histories",
    "interview transcripts dataset",
    "semi-structured interview transcripts",
    "key informant interviews",
    "KII qualitative",
    "focus group transcripts",
    "focus group discussions qualitative",
    "focus group dataset",
    "FGD transcripts",
    "FGD qualitative",
    "QDPX",
    "QDPX export",
    "Qualitative Data Exchange Schema",
    "DDI-Lifecycle qualitative",
    "DDI-L dataset",
    "QuDEx XML",
    "NVivo project",
    "NVivo export",
    "Atlas.ti qualitative",
    "MAXQDA dataset",
    "Dedoose qualitative",
    "CAQDAS export",
    "ethnographic study",
    "participant observation",
    "ethnographic field notes",
    "fieldwork notes",
    "observational qualitative data",
    "visual ethnography",
    "thematic analysis interviews",
    "discourse analysis dataset",
    "content analysis qualitative",
    "coding qualitative data",
    "grounded theory study",
    "interpretative phenomenological analysis",
    "IPA qualitative study",
    "data saturation qualitative",
    "transcripts dataset",
    "audio interviews dataset",
    "video interviews research",
    "diary study data",
    "open-ended survey responses",
    "RTF transcripts",
    "text corpus qualitative",
    "qualitative case study interviews",
    "case study interview transcripts",
    "narrative analysis dataset",
    "narrative study interviews",
    "discourse analysis interviews",
    "purposive sampling qualitative",
    "snowball sampling interviews",
    "theoretical sampling dataset",
    "maximum variation sampling",
    "qualitative interviews health",
    "qualitative study education",
    "ethnography education dataset",
    "focus group climate change",
    "narrative study migration",
    "interview transcripts qualitative research",
    "focus group transcripts qualitative",
    "ethnographic field notes dataset",
    "oral history transcripts dataset",
    "thematic analysis interview data",
    "qualitative interview text corpus",
    "participant observation field notes",
    "unstructured interview data",
    "qualitative research text data",
    "interview-based qualitative dataset",
)

# ---------------------------------------------------------------------------
# ISIC Rev.5 sections (letter, title) and divisions (section, code, title)
# ---------------------------------------------------------------------------
SECTIONS = (
    ("A", "Agriculture, forestry and fishing"),
    ("B", "Mining and quarrying"),
    ("C", "Manufacturing"),
    ("D", "Electricity, gas, steam and air conditioning supply"),
    ("E", "Water supply; sewerage, waste management and remediation activities"),
    ("F", "Construction"),
    ("G", "Wholesale and retail trade"),
    ("H", "Transportation and storage"),
    ("I", "Accommodation and food service activities"),
    ("J", "Publishing, broadcasting, and content production and distribution activities"),
    ("K", "Telecommunications, computer programming, consultancy, computing infrastructure, and other information service activities"),
    ("L", "Financial and insurance activities"),
    ("M", "Real estate activities"),
    ("N", "Professional, scientific and technical activities"),
    ("O", "Administrative and support service activities"),
    ("P", "Public administration and defense; compulsory social security"),
    ("Q", "Education"),
    ("R", "Human health and social work activities"),
    ("S", "Arts, sports and recreation"),
    ("T", "Other service activities"),
    ("U", "Activities of households as employers; undifferentiated goods- and services-producing activities of households for own use"),
    ("V", "Activities of extraterritorial organizations and bodies"),
)

DIVISIONS = (
    ("A", "01", "Crop and animal production, hunting and related service activities"),
    ("A", "02", "Forestry and logging"),
    ("A", "03", "Fishing and aquaculture"),
    ("B", "05", "Mining of coal and lignite"),
    ("B", "06", "Extraction of crude petroleum and natural gas"),
    ("B", "07", "Mining of metal ores"),
    ("B", "08", "Other mining and quarrying"),
    ("B", "09", "Mining support service activities"),
    ("C", "10", "Manufacture of food products"),
    ("C", "11", "Manufacture of beverages"),
    ("C", "12", "Manufacture of tobacco products"),
    ("C", "13", "Manufacture of textiles"),
    ("C", "14", "Manufacture of wearing apparel"),
    ("C", "15", "Manufacture of leather and related products"),
    ("C", "16", "Manufacture of wood and of products of wood and cork, except furniture; manufacture of articles of straw and plaiting materials"),
    ("C", "17", "Manufacture of paper and paper products"),
    ("C", "18", "Printing and reproduction of recorded media"),
    ("C", "19", "Manufacture of coke and refined petroleum products"),
    ("C", "20", "Manufacture of chemicals and chemical products"),
    ("C", "21", "Manufacture of basic pharmaceutical products and pharmaceutical preparations"),
    ("C", "22", "Manufacture of rubber and plastic products"),
    ("C", "23", "Manufacture of other non-metallic mineral products"),
    ("C", "24", "Manufacture of basic metals"),
    ("C", "25", "Manufacture of fabricated metal products, except machinery and equipment"),
    ("C", "26", "Manufacture of computer, electronic and optical products"),
    ("C", "27", "Manufacture of electrical equipment"),
    ("C", "28", "Manufacture of machinery and equipment n.e.c."),
    ("C", "29", "Manufacture of motor vehicles, trailers and semi-trailers"),
    ("C", "30", "Manufacture of other transport equipment"),
    ("C", "31", "Manufacture of furniture"),
    ("C", "32", "Other manufacturing"),
    ("C", "33", "Repair, maintenance and installation of machinery and equipment"),
    ("D", "35", "Electricity, gas, steam and air conditioning supply"),
    ("E", "36", "Water collection, treatment and supply"),
    ("E", "37", "Sewerage"),
    ("E", "38", "Waste collection, treatment and disposal, and recovery activities"),
    ("E", "39", "Remediation and other waste management service activities"),
    ("F", "41", "Construction of residential and non-residential buildings"),
    ("F", "42", "Civil engineering"),
    ("F", "43", "Specialized construction activities"),
    ("G", "46", "Wholesale trade"),
    ("G", "47", "Retail trade"),
    ("H", "49", "Land transport and transport via pipelines"),
    ("H", "50", "Water transport"),
    ("H", "51", "Air transport"),
    ("H", "52", "Warehousing and support activities for transportation"),
    ("H", "53", "Postal and courier activities"),
    ("I", "55", "Accommodation"),
    ("I", "56", "Food and beverage service activities"),
    ("J", "58", "Publishing activities"),
    ("J", "59", "Motion picture, video and television programme production, sound recording and music publishing activities"),
    ("J", "60", "Programming, broadcasting, news agency and other content distribution activities"),
    ("K", "61", "Telecommunications"),
    ("K", "62", "Computer programming, consultancy and related activities"),
    ("K", "63", "Computing infrastructure, data processing, hosting, and other information service activities"),
    ("L", "64", "Financial service activities, except insurance and pension funding"),
    ("L", "65", "Insurance, reinsurance and pension funding, except compulsory social security"),
    ("L", "66", "Activities auxiliary to financial service and insurance activities"),
    ("M", "68", "Real estate activities"),
    ("N", "69", "Legal and accounting activities"),
    ("N", "70", "Activities of head offices; management consultancy activities"),
    ("N", "71", "Architectural and engineering activities; technical testing and analysis"),
    ("N", "72", "Scientific research and development"),
    ("N", "73", "Activities of advertising, market research and public relations"),
    ("N", "74", "Other professional, scientific and technical activities"),
    ("N", "75", "Veterinary activities"),
    ("O", "77", "Rental and leasing activities"),
    ("O", "78", "Employment activities"),
    ("O", "79", "Travel agency, tour operator, and other travel related activities"),
    ("O", "80", "Investigation and security activities"),
    ("O", "81", "Services to buildings and landscape activities"),
    ("O", "82", "Office administrative, office support and other business support activities"),
    ("P", "84", "Public administration and defence; compulsory social security"),
    ("Q", "85", "Education"),
    ("R", "86", "Human health activities"),
    ("R", "87", "Residential care activities"),
    ("R", "88", "Social work activities without accommodation"),
    ("S", "90", "Arts creation and performing arts activities"),
    ("S", "91", "Library, archives, museum and other cultural activities"),
    ("S", "92", "Gambling and betting activities"),
    ("S", "93", "Sports activities and amusement and recreation activities"),
    ("T", "94", "Activities of membership organizations"),
    ("T", "95", "Repair and maintenance of computers, personal and household goods, and motor vehicles and motorcycles"),
    ("T", "96", "Personal service activities"),
    ("U", "97", "Activities of households as employers of domestic personnel"),
    ("U", "98", "Undifferentiated goods- and services-producing activities of private households for own use"),
    ("V", "99", "Activities of extraterritorial organizations and bodies"),
)


def _table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """Rows as an inline table, whose size Spark knows when it plans a join."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, int):
            return f"{value}L"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def extensions_table(spark: SparkSession) -> DataFrame:
    """(extension, category, tool): qda, primary and junk extensions."""
    rows = [(e, "qda", tool) for tool, exts in QDA_TOOL_EXTENSIONS.items() for e in exts]
    rows += [(e, "primary", None) for e in PRIMARY_DATA_EXTENSIONS]
    rows += [(e, "junk", None) for e in JUNK_EXTENSIONS]
    return _table(spark, "extension, category, tool", rows)


def repositories_table(spark: SparkSession) -> DataFrame:
    """(repository_id, label), 20 rows."""
    return _table(spark, "repository_id, label", list(REPOSITORY_LABELS))


def type_labels_table(spark: SparkSession) -> DataFrame:
    """(type_order, type, type_label), 4 rows in report order."""
    rows = [(i, t, label) for i, (t, label) in enumerate(TYPE_LABELS, 1)]
    return _table(spark, "type_order, type, type_label", rows)


def report_sections_table(spark: SparkSession) -> DataFrame:
    """(section_no, section_title, slug), 19 rows in report order."""
    rows = [(i, title, slug) for i, (title, slug) in enumerate(REPORT_SECTIONS, 1)]
    return _table(spark, "section_no, section_title, slug", rows)


def sections_table(spark: SparkSession) -> DataFrame:
    return _table(spark, "section, section_title", list(SECTIONS))


def divisions_table(spark: SparkSession) -> DataFrame:
    """(idx, section, code, title) in taxonomy order; idx starts at 0 and breaks ties."""
    rows = [(i, *d) for i, d in enumerate(DIVISIONS)]
    return _table(spark, "idx, section, code, title", rows)


def query_terms_table(spark: SparkSession) -> DataFrame:
    return _table(spark, "term", [(t,) for t in QUERY_TERMS])


def read_extensions(spark: SparkSession, path: str) -> DataFrame:
    """(tool, extension) from a JSON object of extension lists, lower case and without dots."""
    text = spark.read.text(path, wholetext=True)
    tools = F.from_json("value", "map<string, array<string>>")
    listed = text.select(F.explode(tools).alias("tool", "extensions")).select("tool", F.explode("extensions").alias("extension"))
    bare = F.ltrim(F.lower(F.trim("extension")), F.lit("."))
    return listed.select("tool", bare.alias("extension")).distinct()


def read_taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Taxonomy from a JSON document with a ``sections`` object and a ``divisions`` array.

    ``posexplode`` keeps the array order, which is the tie order of the classification.
    """
    schema = (
        "sections map<string,string>, "
        "divisions array<struct<section: string, code: string, title: string>>"
    )
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    sections = doc.select(F.explode("sections").alias("section", "section_title"))
    divisions = doc.select(F.posexplode("divisions").alias("idx", "d")).select(
        F.col("idx").cast("long").alias("idx"), "d.section", "d.code", "d.title"
    )
    return sections, divisions
