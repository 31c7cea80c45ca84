"""Where the tables of one lake lie."""

from __future__ import annotations

from dataclasses import dataclass

from urnalake import schema as S


@dataclass(frozen=True)
class Lake:
    """Audit logs and landing files stay outside the table folders that readers list."""

    root: str

    def _folder(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._folder("bronze", S.BRONZE_DATASET)

    @property
    def silver(self) -> str:
        return self._folder("silver", S.BRONZE_DATASET)

    @property
    def checked(self) -> str:
        """Silver rows after the value rules, beside the rows that break one."""
        return self._folder("checked", S.BRONZE_DATASET)

    @property
    def cells(self) -> str:
        """Mergeable rollup measures of every silver year."""
        return self._folder("cells", S.BRONZE_DATASET)

    @property
    def bronze_log(self) -> str:
        return self._folder("audit", "bronze")

    @property
    def silver_log(self) -> str:
        return self._folder("audit", "silver")

    @property
    def landing(self) -> str:
        return self._folder("landing")

    @property
    def samples(self) -> str:
        return self._folder("samples")
