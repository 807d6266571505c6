"""Table contracts, CSV read options and fixed-width layouts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    max_length: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class TableContract:
    """Ordered, typed columns of a target table."""

    fields: tuple[Field, ...]

    @classmethod
    def of(cls, *columns: tuple) -> TableContract:
        return cls(tuple(Field(*c) for c in columns))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), f.nullable) for f in self.fields]
        )

    def apply(self, df: DataFrame) -> DataFrame:
        """Project to contract order and types; a missing column is an error,
        a value that does not cast becomes NULL."""
        have = {c.lower() for c in df.columns}
        missing = [n for n in self.names if n.lower() not in have]
        if missing:
            raise ValueError(f"columns missing from input: {missing}")
        return df.select(*[F.col(f.name).try_cast(f.type).alias(f.name) for f in self.fields])


@dataclass(frozen=True)
class CsvSpec:
    """Options of a delimited read. Malformed rows fail the read by default;
    ``permissive`` keeps them in ``_corrupt_record``."""

    sep: str = ","
    header: bool = False
    null_value: str | None = None
    permissive: bool = False
    date_format: str | None = None
    timestamp_format: str | None = None
    multi_line: bool = False
    encoding: str = "UTF-8"
    quote: str = '"'
    escape: str = "\\"
    comment: str | None = None
    trim: bool = False

    def options(self) -> dict[str, str]:
        flag = {True: "true", False: "false"}
        opts = {
            "sep": self.sep,
            "header": flag[self.header],
            "mode": "PERMISSIVE" if self.permissive else "FAILFAST",
            "multiLine": flag[self.multi_line],
            "encoding": self.encoding,
            "quote": self.quote,
            "escape": self.escape,
            "ignoreLeadingWhiteSpace": flag[self.trim],
            "ignoreTrailingWhiteSpace": flag[self.trim],
            "nullValue": self.null_value,
            "dateFormat": self.date_format,
            "timestampFormat": self.timestamp_format,
            "timestampNTZFormat": self.timestamp_format,
            "comment": self.comment,
        }
        return {k: v for k, v in opts.items() if v is not None}


@dataclass(frozen=True)
class Slot:
    """One field of a fixed-width record; ``start`` counts from 1."""

    name: str
    start: int
    length: int
    type: str = "string"
    fmt: str | None = None


@dataclass(frozen=True)
class Layout:
    slots: tuple[Slot, ...] = field(default_factory=tuple)

    @classmethod
    def of(cls, *slots: tuple) -> Layout:
        return cls(tuple(Slot(*s) for s in slots))


def layout_from_ranges(ranges: str) -> Layout:
    """``"1-6,7-8"`` (both ends inclusive) to field1, field2, ..."""
    slots = []
    for i, part in enumerate(ranges.split(","), start=1):
        lo, hi = (int(x) for x in part.strip().split("-"))
        if lo < 1 or hi < lo:
            raise ValueError(f"bad range {part!r}")
        slots.append(Slot(f"field{i}", lo, hi - lo + 1))
    return Layout(tuple(slots))


# Positions of the objective files, (name, start, length, type, format).
OBJECTIVE_LAYOUTS: dict[str, Layout] = {
    "BAC": Layout.of(
        ("Biz_Assoc_Id", 6, 6, "bigint"),
        ("Sell_Src_Cd", 12, 2, "int"),
        ("Brand_Cd", 14, 3),
        ("Rpt_Dt", 17, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 25, 7, "int"),
    ),
    "REG": Layout.of(
        ("Region_Cd", 10, 2),
        ("Sell_Src_Cd", 12, 2, "int"),
        ("Brand_Cd", 14, 3),
        ("Rpt_Dt", 17, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 25, 7, "int"),
    ),
    "ZON": Layout.of(
        ("Region_Cd", 10, 2),
        ("Sec_Cd", 14, 2),
        ("Zone_Cd", 16, 4),
        ("Sell_Src_Cd", 20, 2, "int"),
        ("Brand_Cd", 22, 3),
        ("Rpt_Dt", 25, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 33, 7, "int"),
    ),
    "ARE": Layout.of(
        ("Region_Cd", 10, 2),
        ("Sec_Cd", 14, 2),
        ("Zone_Cd", 16, 4),
        ("Area_Cd", 20, 4),
        ("Sell_Src_Cd", 24, 2, "int"),
        ("Brand_Cd", 26, 3),
        ("Rpt_Dt", 29, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 37, 7, "int"),
    ),
    "GMM": Layout.of(
        ("field1", 10, 2),
        ("field2", 14, 2),
        ("field3", 16, 4),
        ("field4", 20, 4),
        ("field5", 24, 4),
        ("field6", 28, 4),
        ("field7", 32, 4),
        ("field8", 36, 4),
        ("field9", 40, 4),
        ("field10", 44, 4),
    ),
    "NAT": Layout.of(
        ("Sell_Src_Cd", 3, 2, "int"),
        ("Brand_Cd", 5, 3),
        ("Rpt_Dt", 8, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 16, 7, "int"),
    ),
    "SEC": Layout.of(
        ("Region_Cd", 10, 4),
        ("Sec_Cd", 14, 4),
        ("Brand_Cd", 18, 3),
        ("Rpt_Dt", 21, 8, "date", "MMddyyyy"),
        ("Obj_Cnt", 29, 7, "int"),
    ),
}

# Target columns of the fleet and courtesy tables.
FLEET_TARGET = TableContract.of(
    ("Rpt_Dt", "date"),
    ("Sales_Thru_Dt", "date"),
    ("Sales_Mth_Cat_Nbr", "int"),
    ("Src_Sys_Id", "string"),
    ("Sales_Mth_Cat", "string"),
    ("Day_Sales_Cnt", "int"),
    ("Mth_To_Dt_Sales_Cnt", "int"),
    ("Rpt_Mth_Nbr", "int"),
    ("Rpt_Mth_Abbr_Txt", "string"),
    ("Src_Sys_Uniq_Prim_Key_Val", "string"),
    ("Src_Sys_Uniq_Prim_Key_Col_Val", "string"),
    ("Meas_Cnt", "int"),
    ("Dw_Anom_Flg", "string"),
    ("Dw_Mod_Ts", "timestamp_ntz"),
    ("Dw_Job_Id", "string"),
    ("Src_Sys_Iud_Cd", "string"),
)

FLEET_REDUCED_TARGET = TableContract.of(
    ("Rpt_Dt", "date"),
    ("Sales_Thru_Dt", "date"),
    ("Src_Sys_Id", "string"),
    ("Day_Sales_Cnt", "int"),
    ("Mth_To_Dt_Sales_Cnt", "int"),
    ("Rpt_Mth_Nbr", "int"),
    ("Rpt_Mth_Abbr_Txt", "string"),
    ("Src_Sys_Uniq_Prim_Key_Val", "string"),
    ("Src_Sys_Uniq_Prim_Key_Col_Val", "string"),
    ("Meas_Cnt", "int"),
    ("Dw_Anom_Flg", "string"),
    ("Dw_Mod_Ts", "timestamp_ntz"),
    ("Dw_Job_Id", "string"),
    ("Src_Sys_Iud_Cd", "string"),
)

COURTESY_TARGET = TableContract.of(
    ("Veh_Id_Nbr", "string", 20),
    ("File_Dt", "date"),
    ("Out_Svc_Dt", "date"),
    ("Src_Sys_Id", "string", 20),
    ("In_Svc_Dt", "date"),
    ("Biz_Assoc_Id", "bigint"),
    ("Day_In_Svc_Cnt", "int"),
    ("Out_Svc_Mil_Cnt", "int"),
    ("Out_Svc_Type_Cd", "string", 20),
    ("Sell_Src_Desc", "string", 20),
    ("Sell_Src_Cd", "int"),
    ("Veh_Prod_Rpt_Model_Cd", "string", 20),
    ("Model_Yr", "int"),
    ("Loan_Great_Than_60_Day_Cd", "string", 20),
    ("Src_Sys_Uniq_Prim_Key_Val", "string", 500),
    ("Src_Sys_Uniq_Prim_Key_Col_Val", "string", 500),
    ("Meas_Cnt", "int"),
    ("Dw_Anom_Flg", "string", 1),
    ("Dw_Mod_Ts", "timestamp_ntz"),
    ("Dw_Job_Id", "string", 50),
    ("Src_Sys_Iud_Cd", "string", 1),
)

OUT_OF_SERVICE_STAGING = TableContract.of(
    ("VIN", "string", 20),
    ("outDate", "date"),
    ("outMile", "int"),
    ("todayDate", "date"),
    ("outType", "string", 20),
    ("daysInService", "int"),
    ("loanGreaterThan60", "string", 10),
)
