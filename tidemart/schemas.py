"""Explicit schemas of the feeds; nothing is inferred."""

from __future__ import annotations

BAD_RECORD = "_corrupt_record"

COMMON = (
    "struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,"
    "os:string,sid:string,uid:string,vc:string>"
)
PAGE = (
    "struct<during_time:bigint,from_pos_id:bigint,from_pos_seq:bigint,item:string,"
    "item_type:string,last_page_id:string,page_id:string>"
)
DISPLAY = "struct<item:string,item_type:string,pos_id:bigint,pos_seq:bigint>"
ACTION = "struct<action_id:string,item:string,item_type:string,ts:bigint>"
START = "struct<entry:string,loading_time:bigint>"
ERR = "struct<error_code:bigint,msg:string>"

# ``ts`` is read as text and cast afterwards, so quoted and bare numbers both work.
APP_LOG_FIELDS = {
    "common": COMMON,
    "page": PAGE,
    "displays": f"array<{DISPLAY}>",
    "actions": f"array<{ACTION}>",
    "start": START,
    "err": ERR,
    "ts": "string",
}

ENVELOPE_FIELDS = {
    "op": "string",
    "db": "string",
    "before": "map<string,string>",
    "after": "map<string,string>",
    "source": "map<string,string>",
    "ts_ms": "bigint",
}

CONFIG_DIM_COLUMNS = [
    "source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key",
]
CONFIG_DWD_COLUMNS = ["source_table", "source_type", "sink_table", "sink_columns"]
AUDIT_COLUMNS = ["id", "op", "db_name", "log_before", "log_after", "t_name", "ts"]


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


def app_log(*names: str) -> dict[str, str]:
    """The app-log fields asked for (all by default), in feed order."""
    return {n: k for n, k in APP_LOG_FIELDS.items() if not names or n in names}


def envelope(*names: str) -> dict[str, str]:
    return {n: k for n, k in ENVELOPE_FIELDS.items() if not names or n in names}
