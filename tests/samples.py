"""Literal samples: the control rows of the state scenarios and sample files."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

from tidemark import model as m

# --- Fixed values: sample files for the file loads ----------------------------

CURRENCY_RATES = """RateDate,BaseCurrency,TargetCurrency,ExchangeRate,SourceSystem
2026-05-01,USD,MXN,17.0500,reference_files
2026-05-01,EUR,MXN,18.4200,reference_files
2026-05-01,USD,EUR,0.9250,reference_files
2026-05-02,USD,MXN,17.0800,reference_files
2026-05-02,EUR,MXN,18.4600,reference_files
2026-05-02,USD,EUR,0.9265,reference_files
2026-05-03,USD,MXN,17.1100,reference_files
2026-05-03,EUR,MXN,18.5000,reference_files
2026-05-03,USD,EUR,0.9280,reference_files"""

COUNTRY_CURRENCY = """CountryCode,CountryName,CurrencyCode,CurrencyName,IsActive
MX,Mexico,MXN,Mexican Peso,1
US,United States,USD,US Dollar,1
CA,Canada,CAD,Canadian Dollar,1
ES,Spain,EUR,Euro,1
FR,France,EUR,Euro,1
DE,Germany,EUR,Euro,1
JP,Japan,JPY,Japanese Yen,1
BR,Brazil,BRL,Brazilian Real,1"""

MANUAL_ADJUSTMENTS = {
    "adjustment_batch_id": "ADJ-2026-05-001",
    "source_system_name": "reference_files",
    "created_at": "2026-05-11T00:00:00.000Z",
    "adjustments": [
        {
            "adjustment_id": "ADJ-0001",
            "entity_type": "Order",
            "entity_reference": "ORD-00002",
            "adjustment_type": "REFUND_REVIEW",
            "reason": "Manual review marker for refund scenario testing.",
            "is_active": True,
        },
        {
            "adjustment_id": "ADJ-0002",
            "entity_type": "Customer",
            "entity_reference": "CUST-0001",
            "adjustment_type": "CONTACT_UPDATE_REVIEW",
            "reason": "Manual review marker for incremental update scenario testing.",
            "is_active": True,
        },
    ],
}

SOURCE_METADATA = {
    "source_system_name": "sales_local",
    "source_type": "SQL Server",
    "environment": "dev",
    "description": "A sales database on one server.",
    "tables": [
        {
            "schema": "dbo",
            "table": table,
            "load_type": "INCREMENTAL",
            "watermark_column": "UpdatedAt",
        }
        for table in ("Customers", "Products", "Orders", "OrderItems", "Payments")
    ],
}

# One good line, one with a bad date and number, one with two fields only.
DAMAGED_RATES = """RateDate,BaseCurrency,TargetCurrency,ExchangeRate,SourceSystem
2026-05-01,USD,MXN,17.0500,reference_files
notadate,USD,MXN,xx,reference_files
2026-05-02,EUR"""


def write_samples(folder: Path) -> dict[str, str]:
    """The sample files under `folder`; name → path."""
    folder.mkdir(parents=True, exist_ok=True)
    texts = {
        "currency_rates.csv": CURRENCY_RATES,
        "country_currency.csv": COUNTRY_CURRENCY,
        "damaged_rates.csv": DAMAGED_RATES,
        "manual_adjustments.json": json.dumps(MANUAL_ADJUSTMENTS, indent=2),
        "source_system_metadata.json": json.dumps(SOURCE_METADATA, indent=2),
    }
    for name, text in texts.items():
        (folder / name).write_text(text)
    return {name: str(folder / name) for name in texts}


# --- Control rows -------------------------------------------------------------

DAY = {n: datetime(2026, 1, n) for n in range(1, 10)}
ORDERS_ID = 3


def source_row(source_id=ORDERS_ID, name="Orders", mark=m.SENTINEL, **other):
    row = {
        "SourceObjectId": source_id,
        "SourceSystemName": "sales_local",
        "SourceType": m.SQL_TABLE,
        "SourceSchema": "dbo",
        "SourceObjectName": name,
        "LoadType": "INCREMENTAL",
        "WatermarkColumn": "UpdatedAt",
        "IsActive": True,
        "LastWatermarkValue": mark,
        "DestinationContainer": "bronze",
        "DestinationFolder": f"sqlserver/sales_local/dbo/{name.lower()}",
        "DestinationFormat": "parquet",
        "UpdatedAt": DAY[1],
    }
    return {**row, **other}


def run_row(run_id, status, started, source_id=ORDERS_ID, name="Orders", **other):
    row = {
        "RunId": run_id,
        "SourceObjectId": source_id,
        "SourceObjectName": name,
        "Status": status,
        "StartedAt": started,
    }
    return {**row, **other}


def history_row(history_id, run_id, mark, source_id=ORDERS_ID, applied=DAY[4]):
    return {
        "WatermarkHistoryId": history_id,
        "SourceObjectId": source_id,
        "RunId": run_id,
        "NewWatermarkValue": mark,
        "AppliedAt": applied,
    }


def frame(spark, schema, rows):
    return spark.createDataFrame(
        [tuple(row.get(name) for name in schema.names) for row in rows], schema
    )


def registry(spark, *rows):
    return frame(spark, m.SOURCE_OBJECT, rows)


def runs(spark, *rows):
    return frame(spark, m.INGESTION_RUN, rows)


def history(spark, *rows):
    return frame(spark, m.WATERMARK_HISTORY, rows)


def source(spark, *marks):
    return spark.createDataFrame(
        [(i, mark) for i, mark in enumerate(marks)], "Id int, UpdatedAt timestamp_ntz"
    )
