"""Addresses of tables: (layer, project, database, table) to paths."""

from __future__ import annotations

from dataclasses import dataclass

from ebbtide.config import DEFAULT, Settings


@dataclass(frozen=True)
class TableRef:
    project_name: str
    database: str
    table_name: str

    @classmethod
    def from_topic(cls, topic: str) -> TableRef:
        parts = topic.split(".")
        if len(parts) != 3 or not all(parts):
            raise ValueError(f"topic {topic!r} is not of the form project.database.table")
        return cls(*parts)

    @property
    def topic(self) -> str:
        return f"{self.project_name}.{self.database}.{self.table_name}"

    def path(self, layer: str, settings: Settings = DEFAULT) -> str:
        return mount_path(layer, self.project_name, self.database, self.table_name, settings)

    def checkpoint(self, layer: str, settings: Settings = DEFAULT) -> str:
        return mount_checkpoint_path(
            layer, self.project_name, self.database, self.table_name, settings
        )

    def history(self, layer: str, settings: Settings = DEFAULT) -> str:
        return mount_history_path(
            layer, self.project_name, self.database, self.table_name, settings
        )


def mount_path(
    layer: str | None = None,
    project_name: str | None = None,
    database: str | None = None,
    table_name: str | None = None,
    settings: Settings = DEFAULT,
) -> str | None:
    """Data path of a table, or None if a part of the address is missing."""
    if None in (layer, project_name, database, table_name):
        return None
    return f"{settings.url(settings.bucket(layer))}/{project_name}/{database}/{table_name}"


def mount_checkpoint_path(
    layer: str | None = None,
    project_name: str | None = None,
    database: str | None = None,
    table_name: str | None = None,
    settings: Settings = DEFAULT,
) -> str | None:
    """Checkpoint of the stream that fills a table, or None as in mount_path."""
    if None in (layer, project_name, database, table_name):
        return None
    return _control(settings, "_checkpoint", layer, project_name, database, table_name)


def mount_history_path(
    layer: str, project_name: str, database: str, table_name: str, settings: Settings = DEFAULT
) -> str:
    """Path of the per-version history of a table."""
    return _control(settings, "_history", layer, project_name, database, table_name)


def _control(settings: Settings, area: str, layer: str, *names: str) -> str:
    root = settings.url(settings.spark_control)
    return "/".join([root, area, settings.bucket(layer), *names])
