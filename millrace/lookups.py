"""Fixed lookup tables and how they become DataFrames.

Operators take lookups as parameters; these are the default contents.  All of them
are small and of constant size, so joins against them may broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# ---------------------------------------------------------------------------
# These must equal the published data conventions for results to
# match, so they are stated as plain text.
# ---------------------------------------------------------------------------

# State name; code.
STATES = """
Alabama; AL
Alaska; AK
Arizona; AZ
Arkansas; AR
California; CA
Colorado; CO
Connecticut; CT
Delaware; DE
District of Columbia; DC
Florida; FL
Georgia; GA
Hawaii; HI
Idaho; ID
Illinois; IL
Indiana; IN
Iowa; IA
Kansas; KS
Kentucky; KY
Louisiana; LA
Maine; ME
Maryland; MD
Massachusetts; MA
Michigan; MI
Minnesota; MN
Mississippi; MS
Missouri; MO
Montana; MT
Nebraska; NE
Nevada; NV
New Hampshire; NH
New Jersey; NJ
New Mexico; NM
New York; NY
North Carolina; NC
North Dakota; ND
Ohio; OH
Oklahoma; OK
Oregon; OR
Pennsylvania; PA
Rhode Island; RI
South Carolina; SC
South Dakota; SD
Tennessee; TN
Texas; TX
Utah; UT
Vermont; VT
Virginia; VA
Washington; WA
West Virginia; WV
Wisconsin; WI
Wyoming; WY
"""

# Unit of each economic series.
SERIES_UNITS = """
NY.ADJ.NNAT.GN.ZS PERCENTAGE
NY.GNP.PCAP.PP.KD USD_CONSTANT
NY.GDP.MKTP.PP.CD USD_CURRENT
CM.MKT.TRAD.CD USD_CURRENT
FP.CPI.TOTL INDEX
GC.REV.XGRT.GD.ZS PERCENTAGE
TM.VAL.MRCH.CD.WT USD_CURRENT
GC.DOD.TOTL.CN LCU_CURRENT
GC.XPN.TOTL.GD.ZS PERCENTAGE
FB.AST.NPER.ZS PERCENTAGE
NY.ADJ.NNTY.KD.ZG PERCENTAGE
PA.NUS.ATLS LCU_CURRENT
NY.GDP.DEFL.KD.ZG PERCENTAGE_GROWTH
NE.GDI.STKB.CD USD_CURRENT
GC.DOD.TOTL.GD.ZS PERCENTAGE
NY.GDP.MKTP.PP.KD USD_CONSTANT
BN.CAB.XOKA.GD.ZS PERCENTAGE
NE.EXP.GNFS.KD USD_CONSTANT
NE.RSB.GNFS.CD USD_CURRENT
NE.EXP.GNFS.CD USD_CURRENT
CM.MKT.TRAD.GD.ZS PERCENTAGE
FS.AST.PRVT.GD.ZS PERCENTAGE
DT.DOD.DECT.CD USD_CURRENT
FM.LBL.BMNY.CN LCU_CURRENT
FM.LBL.BMNY.ZG PERCENTAGE
NE.IMP.GNFS.CD USD_CURRENT
CM.MKT.LCAP.CD USD_CURRENT
NE.CON.PRVT.KD.ZG PERCENTAGE
NE.GDI.TOTL.CD USD_CURRENT
CM.MKT.TRNR PERCENTAGE
NE.CON.PRVT.CD USD_CURRENT
PX.REX.REER INDEX
NY.GNP.MKTP.CD USD_CURRENT
NY.GDP.MKTP.KD USD_CONSTANT
NV.AGR.TOTL.ZS PERCENTAGE
NY.GDP.MKTP.KD.ZG PERCENTAGE
NV.SRV.TOTL.ZS PERCENTAGE
FR.INR.RINR PERCENTAGE
NY.GDP.PCAP.KD USD_CONSTANT
NE.IMP.GNFS.KD.ZG PERCENTAGE
PA.NUS.PRVT.PP INTERNATIONAL_DOLLAR_CONSTANT
NV.IND.TOTL.ZS PERCENTAGE
NV.IND.MANF.ZS PERCENTAGE
NE.GDI.TOTL.KD.ZG PERCENTAGE
NE.GDI.FTOT.ZS PERCENTAGE
NE.GDI.TOTL.KD USD_CONSTANT
NY.GNP.PCAP.CD USD_CURRENT
NY.GNS.ICTR.ZS PERCENTAGE
NY.GNP.PCAP.PP.CD USD_CURRENT
NY.GDP.DEFL.KD.ZG.AD PERCENTAGE
TX.VAL.TECH.CD USD_CURRENT
NY.GNP.MKTP.PP.CD USD_CURRENT
FP.CPI.TOTL.ZG PERCENTAGE
NE.CON.GOVT.ZS PERCENTAGE
FI.RES.XGLD.CD USD_CURRENT
NE.CON.TOTL.ZS PERCENTAGE
IC.CRD.INFO.XQ INDEX
SL.TLF.TOTL.IN COUNT
BN.GSR.FCTY.CD USD_CURRENT
TM.TAX.MRCH.WM.AR.ZS PERCENTAGE
NY.GDP.PCAP.CD USD_CURRENT
NE.CON.GOVT.CD USD_CURRENT
PA.NUS.PPPC.RF RATIO
BM.GSR.GNFS.CD USD_CURRENT
NY.GDP.PCAP.KD.ZG PERCENTAGE
NE.GDI.TOTL.ZS PERCENTAGE
FI.RES.TOTL.MO COUNT
NY.GNS.ICTR.CD USD_CURRENT
NE.IMP.GNFS.KD USD_CONSTANT
NE.IMP.GNFS.ZS PERCENTAGE
NY.GDP.PCAP.PP.KD USD_CONSTANT
NY.GDP.MKTP.CD USD_CURRENT
BM.KLT.DINV.CD.WD USD_CURRENT
NY.GDP.PCAP.PP.CD USD_CURRENT
BX.KLT.DINV.WD.GD.ZS PERCENTAGE
BX.TRF.PWKR.CD.DT USD_CURRENT
NE.EXP.GNFS.KD.ZG PERCENTAGE
BN.CAB.XOKA.CD USD_CURRENT
FD.RES.LIQU.AS.ZS PERCENTAGE
CM.MKT.LCAP.GD.ZS PERCENTAGE
FR.INR.LNDP PERCENTAGE
NE.CON.TOTL.CD USD_CURRENT
PA.NUS.FCRF LCU_CURRENT
BN.RES.INCL.CD USD_CURRENT
FR.INR.LEND PERCENTAGE
CM.MKT.LDOM.NO COUNT
CM.MKT.INDX.ZG PERCENTAGE_GROWTH
GC.NLD.TOTL.GD.ZS PERCENTAGE
BX.GSR.GNFS.CD USD_CURRENT
NE.EXP.GNFS.ZS PERCENTAGE
GC.REV.XGRT.CN LCU_CURRENT
NE.RSB.GNFS.ZS PERCENTAGE
DT.TDS.DECT.EX.ZS PERCENTAGE
FS.AST.DOMS.GD.ZS PERCENTAGE
PA.NUS.PPP INTERNATIONAL_DOLLAR_CONSTANT
NE.CON.PRVT.ZS PERCENTAGE
BX.KLT.DINV.CD.WD USD_CURRENT
SL.UEM.TOTL.ZS PERCENTAGE
NY.ADJ.NNTY.PC.CD USD_CURRENT
FI.RES.TOTL.CD USD_CURRENT
IC.LGL.CRED.XQ INDEX
NY.GDP.DEFL.ZS PERCENTAGE
TX.VAL.TECH.MF.ZS PERCENTAGE
TX.VAL.MRCH.CD.WT USD_CURRENT
TG.VAL.TOTL.GD.ZS PERCENTAGE
FB.CBK.BRCH.P5 OTHER
FB.BNK.CAPA.ZS PERCENTAGE
FM.LBL.BMNY.GD.ZS PERCENTAGE
GC.XPN.TOTL.CN LCU_CURRENT
GC.TAX.TOTL.CN LCU_CURRENT
GC.TAX.TOTL.GD.ZS PERCENTAGE
"""

# Unit of each housing indicator.
HOUSING_UNITS = """
CRAW PERCENTAGE
IRAW UNITS
LRAW USD_CURRENT
NRAW DAYS
RSNA USD_CURRENT
RSSA USD_CURRENT
SAAW USD_CURRENT
SRAW USD_CURRENT
ZABT USD_CURRENT
ZATT USD_CURRENT
ZCON USD_CURRENT
ZSFH USD_CURRENT
"""

# Description of each housing indicator.
HOUSING_DESCRIPTIONS = """
CRAW; Percentage of listings with a price reduction (RAW, ALL HOMES, WEEKLY)
IRAW; Number of properties listed for sale (RAW, ALL HOMES, WEEKLY)
LRAW; Average list price (RAW, ALL HOMES, WEEKLY)
NRAW; Average days to properties enter pending status (RAW, ALL HOMES, WEEKLY)
RSNA; ZOOM rent index, rental trends (SMOOTHED, ALL HOMES + MULTI-FAMILY)
RSSA; ZOOM rent index, rental trends (SMOOTHED + SEASONALLY ADJUSTED)
SAAW; Average sale price (SMOOTHED + SEASONALLY ADJUSTED, ALL HOMES, WEEKLY)
SRAW; Average sale price (RAW, ALL HOMES, WEEKLY)
ZABT; Typical home values - Segment: Bottom Tier
ZATT; Typical home values - Segment: Top Tier
ZCON; Typical home values - Segment: Condo/Co-op
ZSFH; Typical home values - Segment: Single Family Homes
"""

# Words a question may use for an asset or country; its key.
ENTITY_ALIASES = """
bitcoin; BTC/USD
btc; BTC/USD
ethereum; ETH/USD
eth; ETH/USD
apple; AAPL
aapl; AAPL
tesla; TSLA
tsla; TSLA
microsoft; MSFT
msft; MSFT
johnson & johnson; JNJ
johnson and johnson; JNJ
j&j; JNJ
jnj; JNJ
amazon; AMZN
amzn; AMZN
google; GOOGL
googl; GOOGL
alphabet; GOOGL
meta; META
facebook; META
nvidia; NVDA
nvda; NVDA
usa; USA
united states; USA
us; USA
america; USA
"""

# Words for a topic; the economic series they stand for, in order.
SOCIO_KEYWORDS = """
unemployment; SL.UEM.TOTL.ZS
labor force; SL.TLF.TOTL.IN SL.UEM.TOTL.ZS
gdp; NY.GDP.MKTP.CD NY.GDP.MKTP.KD NY.GDP.MKTP.KD.ZG NY.GDP.MKTP.PP.CD NY.GDP.MKTP.PP.KD NY.GDP.PCAP.CD NY.GDP.PCAP.KD NY.GDP.PCAP.KD.ZG NY.GDP.PCAP.PP.CD NY.GDP.PCAP.PP.KD
inflation; FP.CPI.TOTL.ZG NY.GDP.DEFL.KD.ZG NY.GDP.DEFL.KD.ZG.AD FP.CPI.TOTL
exports; NE.EXP.GNFS.CD NE.EXP.GNFS.KD NE.EXP.GNFS.KD.ZG NE.EXP.GNFS.ZS TX.VAL.TECH.CD BX.GSR.GNFS.CD
imports; NE.IMP.GNFS.CD NE.IMP.GNFS.KD NE.IMP.GNFS.KD.ZG NE.IMP.GNFS.ZS TM.VAL.MRCH.CD.WT BM.GSR.GNFS.CD
trade; NE.RSB.GNFS.CD NE.RSB.GNFS.ZS TG.VAL.TOTL.GD.ZS TM.TAX.MRCH.WM.AR.ZS
consumption; NE.CON.TOTL.ZS NE.CON.TOTL.CD NE.CON.PRVT.CD NE.CON.PRVT.ZS NE.CON.PRVT.KD.ZG NE.CON.GOVT.CD NE.CON.GOVT.ZS
investment; NE.GDI.TOTL.CD NE.GDI.TOTL.KD NE.GDI.TOTL.KD.ZG NE.GDI.TOTL.ZS NE.GDI.FTOT.ZS BX.KLT.DINV.CD.WD BX.KLT.DINV.WD.GD.ZS
debt; GC.DOD.TOTL.CN GC.DOD.TOTL.GD.ZS DT.DOD.DECT.CD DT.TDS.DECT.EX.ZS
credit; FS.AST.PRVT.GD.ZS FS.AST.DOMS.GD.ZS FB.AST.NPER.ZS IC.CRD.INFO.XQ
interest rate; FR.INR.RINR FR.INR.LEND FR.INR.LNDP
savings; NY.GNS.ICTR.ZS NY.GNS.ICTR.CD NY.ADJ.NNAT.GN.ZS
revenue; GC.REV.XGRT.GD.ZS GC.REV.XGRT.CN GC.TAX.TOTL.CN GC.TAX.TOTL.GD.ZS
reserves; FI.RES.XGLD.CD FI.RES.TOTL.CD FI.RES.TOTL.MO BN.RES.INCL.CD
population; NY.GDP.PCAP.CD NY.GDP.PCAP.KD NY.GDP.PCAP.PP.CD NY.GDP.PCAP.PP.KD
agriculture; NV.AGR.TOTL.ZS
industry; NV.IND.TOTL.ZS NV.IND.MANF.ZS
services; NV.SRV.TOTL.ZS
"""

# Words for a housing topic; the indicators they stand for, in order.
HOUSING_KEYWORDS = """
price reduction; CRAW
price reductions; CRAW
discount; CRAW
inventory; IRAW
listings; IRAW
homes for sale; IRAW
properties listed; IRAW
list price; LRAW
listing price; LRAW
asking price; LRAW
for sale price; LRAW
days on market; NRAW
time to sell; NRAW
pending days; NRAW
rent; RSNA RSSA
rents; RSNA RSSA
rental price; RSNA RSSA
rental prices; RSNA RSSA
rental index; RSNA RSSA
rent index; RSNA RSSA
sale price; SRAW SAAW
sale prices; SRAW SAAW
home price; SRAW SAAW
home prices; SRAW SAAW
house price; SRAW SAAW
house prices; SRAW SAAW
home values; ZSFH ZCON ZABT ZATT
housing prices; SRAW SAAW
housing price index; SRAW SAAW
home value; ZSFH ZCON ZABT ZATT
typical home value; ZSFH ZCON ZABT ZATT
typical home values; ZSFH ZCON ZABT ZATT
single family home; ZSFH
single family homes; ZSFH
single family; ZSFH
condo; ZCON
condo/co-op; ZCON
condos; ZCON
co-op; ZCON
bottom tier; ZABT
low tier; ZABT
entry level; ZABT
top tier; ZATT
high end; ZATT
luxury; ZATT
"""

# Words of a unit in text; every other unit reads "units".
UNIT_WORDS = """
USD_CURRENT; current US dollars
USD_CONSTANT; constant US dollars
PERCENTAGE; percent
INDEX; index value
COUNT; count
LCU_CURRENT; local currency units
RATIO; ratio
UNKNOWN; units
"""

# Exchange codes of crypto pairs; the symbol used here.
CRYPTO_CODES = """
BTCUSD; BTC/USD
ETHUSD; ETH/USD
SOLUSD; SOL/USD
"""

# Short names accepted by the price query; the symbol used here.
TICKER_ALIASES = """
BTC; BTC/USD
ETH; ETH/USD
SOL; SOL/USD
"""

# Symbols kept by the cleaning job.
WANTED_SYMBOLS = "BTC/USD ETH/USD SOL/USD MSFT NVDA AAPL AMZN GOOGL META AVGO BRK.B TSLA LLY V JNJ XOM WMT JPM BCH/USD"

# Housing indicators kept by the cleaning job.
WANTED_HOUSING = "SAAW SRAW NRAW IRAW CRAW LRAW RSNA RSSA ZSFH ZATT ZABT ZCON"

# First housing date kept; base price level; default country.
HOUSING_SINCE = "2014-01-01"
BASE_CPI = 108.566932118964
CPI_SERIES = "FP.CPI.TOTL"
DEFAULT_COUNTRY = ("USA", "United States")

# How many days behind the newest bar is, per asset type.
LAG_DAYS = {"STOCK": 3, "CRYPTO": 1}

# Words for a span of years; first and last year.
ERAS = """
pandemic; 2020 2021
covid; 2020 2021
before pandemic; 2017 2019
before the pandemic; 2017 2019
pre-pandemic; 2017 2019
pre pandemic; 2017 2019
"""

# A question with one of these asks for yearly figures, and text
# with that marker gives them; the boost such a hit gets.
YEARLY_WORDS = ("average", "annual", "yearly", "per year")
AGGREGATE_MARKERS = ("annual real estate summary",)
YEARLY_BOOST = 0.05

# Fixed value: a name matches an asset only above this similarity.
NAME_MATCH_FLOOR = 0.7


def pairs(text: str, sep: str | None = ";") -> list[tuple[str, str]]:
    """Lines of ``key<sep>value`` as tuples; a later line wins over an earlier one."""
    rows = {}
    for line in text.strip().splitlines():
        key, value = line.split(sep, 1)
        rows[key.strip()] = value.strip()
    return list(rows.items())


def code_lists(text: str) -> list[tuple[str, list[str]]]:
    return [(key, value.split()) for key, value in pairs(text)]


_ARROW = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(),
    "array<string>": pa.list_(pa.string()),
}


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Rows held in the plan itself, so Spark knows how many bytes they are."""
    fields = T.StructType.fromDDL(schema).fields
    columns = [pa.array(list(c), _ARROW[f.dataType.simpleString()]) for f, c in zip(fields, zip(*rows))]
    return spark.createDataFrame(pa.table(columns, names=[f.name for f in fields]))


def table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal table, marked for broadcast."""
    return F.broadcast(literal_table(spark, rows, schema))


def states(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(STATES), "state_name string, state_code string")


def series_units(spark: SparkSession, extra=()) -> DataFrame:
    return table(spark, pairs(SERIES_UNITS, None) + list(extra), "series_id string, unit string")


def housing_units(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(HOUSING_UNITS, None), "indicator_id string, unit string")


def housing_descriptions(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(HOUSING_DESCRIPTIONS), "indicator_id string, description string")


def entity_aliases(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(ENTITY_ALIASES), "alias string, asset_key string")


def ticker_aliases(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(TICKER_ALIASES), "alias string, asset_key string")


def crypto_codes(spark: SparkSession) -> DataFrame:
    return table(spark, pairs(CRYPTO_CODES), "code string, symbol string")


def socio_keywords(spark: SparkSession) -> DataFrame:
    return table(spark, code_lists(SOCIO_KEYWORDS), "keyword string, codes array<string>")


def housing_keywords(spark: SparkSession) -> DataFrame:
    return table(spark, code_lists(HOUSING_KEYWORDS), "keyword string, codes array<string>")


def eras(spark: SparkSession) -> DataFrame:
    rows = [(k, int(v.split()[0]), int(v.split()[1])) for k, v in pairs(ERAS)]
    return table(spark, rows, "phrase string, era_start int, era_end int")
