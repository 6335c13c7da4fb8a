"""Record layouts of the JSON topics. Member names and their order are those of the topics."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE, BOOLEAN = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_CLICK = struct(
    appId=STRING,
    bossUserId=STRING,
    errorMsg=STRING,
    funcId=STRING,
    funcName=STRING,
    logType=INT,
    opDate=STRING,
    opName=STRING,
    orgCode=STRING,
    orgLevel=INT,
    orgName=STRING,
    requestInput=STRING,
    requestUrl=STRING,
    srcIp=STRING,
    success=BOOLEAN,
    supOrgCode=STRING,
    supOrgName=STRING,
    userId=STRING,
    userName=STRING,
)

CLEAN_CLICK = struct(
    appId=STRING,
    funcId=STRING,
    funcName=STRING,
    stropDate=STRING,
    orgCode=STRING,
    orgName=STRING,
    userId=STRING,
    userName=STRING,
    logoptime=STRING,
)

# Two writers use two spellings of the department name; both are accepted when parsing.
FLAT_INTENT = struct(
    strloandate=LONG,
    strdeptcode=STRING,
    detpname=STRING,
    deptname=STRING,
    busiAreaCode=STRING,
    busiAreaName=STRING,
    adminAreaCode=STRING,
    adminAreaName=STRING,
    nborrowmode=STRING,
    lamount=LONG,
    userid=STRING,
    nstate=INT,
    opFlag=STRING,
)
FLAT_CHANGE = struct(**{f.name: f.dataType for f in FLAT_INTENT}, beforeRecord=FLAT_INTENT)


def _cell(kind: T.DataType) -> T.StructType:
    return struct(value=kind, isupdate=BOOLEAN)


# Every column of a change record arrives as {"value": .., "isupdate": ..}.
CDC_COLUMNS = {
    "lid": _cell(LONG),
    "strloandate": _cell(STRING),
    "nborrowmode": _cell(STRING),
    "lamount": _cell(LONG),
    "nstate": _cell(INT),
    "strdeptcode": _cell(STRING),
    "lborrowerid": _cell(STRING),
}
CDC_RECORD = struct(tableName=STRING, opFlag=STRING, **CDC_COLUMNS, beforeRecord=struct(**CDC_COLUMNS))

# A change record after enrichment: the loan date is a bare number, the organisation stands beside the cells.
_ENRICHED = {
    **{**CDC_COLUMNS, "strloandate": LONG},
    **{c: STRING for c in ("detpname", "busiAreaCode", "busiAreaName", "adminAreaCode", "adminAreaName")},
}
ENRICHED_CHANGE = struct(tableName=STRING, opFlag=STRING, **_ENRICHED, beforeRecord=struct(**_ENRICHED))

TABLE_INTENT = struct(
    deptcode=STRING,
    intentID=STRING,
    nborrowmode=STRING,
    strloandate=STRING,
    nstate=INT,
    lamount=LONG,
    userid=LONG,
    deptname=STRING,
    busiAreaCode=STRING,
    busiAreaName=STRING,
    adminAreaCode=STRING,
    adminAreaName=STRING,
)

NESTED_ITEMS = struct(
    dt=STRING, countryCode=STRING, data=T.ArrayType(struct(type=STRING, score=DOUBLE, level=STRING))
)
