"""Settings of a change-stream reader, checked before any plan is built."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

#: Fixed value: the capture mode that a reader may be set to (records of all four are decoded).
CAPTURE_MODES = ("OLD_AND_NEW_VALUES",)
_INSTANT = re.compile(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z")


class ConfigError(ValueError):
    """All problems of a configuration, one a line."""

    def __init__(self, problems: list[str]):
        super().__init__("\n".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class ReaderConfig:
    database: str
    stream: str
    project: str | None = None
    instance: str | None = None
    kind: str = "cloud"  # cloud or omni
    dialect: str = "google"
    heartbeat_ms: int = 300_000
    start: str | None = None
    end: str | None = None
    capture_mode: str = "OLD_AND_NEW_VALUES"
    include_tables: str | None = None
    exclude_tables: str | None = None
    credentials_path: str | None = None
    credentials_json: str | None = None
    host: str | None = None
    emulator_host: str | None = None
    plaintext: bool = False
    ca_cert: str | None = None
    client_cert: str | None = None
    client_key: str | None = None
    max_missed_heartbeats: int = 10
    low_watermark: bool = False
    low_watermark_period_ms: int = 1_000
    low_watermark_stamp_ms: int = 10_000
    finished_partition_delay_ms: int = 7_200_000
    finish_after_commit: bool = True
    min_tasks: int = 2
    max_tasks: int = 10
    desired_partitions_per_task: int = 2
    max_rows_per_batch: int = 10_000

    def problems(self) -> list[str]:
        found = []
        if not 100 <= self.heartbeat_ms <= 300_000:
            found.append("heartbeat_ms must lie between 100 and 300000")
        for name in ("database", "stream"):
            if not (getattr(self, name) or "").strip():
                found.append(f"{name} must not be blank")
        if self.credentials_path is not None and not Path(self.credentials_path).is_file():
            found.append("credentials_path must be an existing file")
        if self.credentials_json is not None:
            try:
                if not self.credentials_json.strip():
                    raise ValueError
                json.loads(self.credentials_json)
            except ValueError:
                found.append("credentials_json must be JSON")
        if self.capture_mode not in CAPTURE_MODES:
            found.append(f"capture_mode must be one of {', '.join(CAPTURE_MODES)}")
        times = {}
        for name in ("start", "end"):
            value = getattr(self, name)
            if value is not None:
                try:
                    if not _INSTANT.fullmatch(value):
                        raise ValueError
                    times[name] = (datetime.fromisoformat(value[:19]), (value[19:-1] or ".0")[1:].ljust(9, "0"))
                except ValueError:
                    found.append(f"{name} must be an instant such as 2024-01-31T00:00:00Z")
        if len(times) == 2 and times["end"] < times["start"]:
            found.append("end must not lie before start")
        if self.kind == "cloud":
            for name in ("project", "instance"):
                if not (getattr(self, name) or "").strip():
                    found.append(f"{name} is needed for a cloud database")
            found += [f"{n} is for omni databases" for n in ("ca_cert", "client_cert", "client_key") if getattr(self, n)]
            if self.plaintext:
                found.append("plaintext is for omni databases")
        elif self.kind == "omni":
            if not self.host:
                found.append("host is needed for an omni database")
            if self.plaintext and (self.ca_cert or self.client_cert or self.client_key):
                found.append("plaintext excludes certificates")
            if bool(self.client_cert) != bool(self.client_key):
                found.append("client_cert and client_key go together")
        else:
            found.append("kind must be cloud or omni")
        if self.host and self.emulator_host:
            found.append("host and emulator_host exclude each other")
        if self.dialect not in ("google", "postgres"):
            found.append("dialect must be google or postgres")
        return found

    def validated(self) -> ReaderConfig:
        if found := self.problems():
            raise ConfigError(found)
        return self

    @classmethod
    def of(cls, settings: dict[str, str]) -> ReaderConfig:
        """From string settings; unknown names and values of the wrong kind are problems like any other."""
        kinds = {f.name: f.type for f in cls.__dataclass_fields__.values()}
        found, got = [], {}
        for k, v in settings.items():
            if k not in kinds:
                found.append(f"unknown setting: {k}")
                continue
            try:
                got[k] = int(v) if kinds[k] == "int" else {"true": True, "false": False}[str(v).lower()] if kinds[k] == "bool" else v
            except (ValueError, KeyError):
                found.append(f"{k} must be {'a whole number' if kinds[k] == 'int' else 'true or false'}")
        try:
            made = cls(**{"database": "", "stream": "", **got})
        except TypeError as e:
            raise ConfigError([*found, str(e)]) from e
        if found := found + made.problems():
            raise ConfigError(found)
        return made
