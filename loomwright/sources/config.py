"""KEY=VALUE settings with typed reads."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    values: dict[str, str]

    @classmethod
    def load(cls, path: str) -> Settings:
        """Blank lines and comments are skipped; quotes around a value are taken off. A missing file has no settings."""
        found = {}
        for line in Path(path).read_text(encoding="utf-8").splitlines() if Path(path).exists() else ():
            name, mark, value = line.strip().removeprefix("export ").partition("=")
            if mark and not name.startswith("#"):
                value = value.strip()
                quote = value[:1]
                if quote and quote in "\"'" and value.find(quote, 1) > 0:
                    value = value[1 : value.find(quote, 1)]
                else:  # a comment may follow a bare value
                    value = value.split(" #")[0].rstrip()
                found[name.strip()] = value
        return cls(found)

    def text(self, name: str, default: str = "") -> str:
        return self.values.get(name) or default

    def whole(self, name: str, default: int) -> int:
        try:
            return int(float(self.values[name]))
        except (KeyError, ValueError, OverflowError):
            return default

    def number(self, name: str, default: float) -> float:
        try:
            return float(self.values[name])
        except (KeyError, ValueError):
            return default

    def flag(self, name: str, default: bool = False) -> bool:
        """Words that say neither yes nor no give the default."""
        said = self.values.get(name, "").lower()
        return True if said in ("1", "true", "yes", "on") else False if said in ("0", "false", "no", "off") else default
