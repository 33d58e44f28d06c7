"""A stand-in for an agency's service, importable by the workers."""

from datetime import datetime, timedelta
from pathlib import Path

from temblor.sources.collector import WindowTooLarge


class FileFetch:
    """Serves one event per hour, at most ``cap`` per request; fails once per window first."""

    def __init__(self, folder, cap=100, failures=0):
        self.folder, self.cap, self.failures = str(folder), cap, failures

    def __call__(self, start, end):
        tries = Path(self.folder) / f"{start:%Y%m%d%H%M}-{end:%Y%m%d%H%M}.tries"
        seen = len(tries.read_text()) if tries.exists() else 0
        tries.write_text("x" * (seen + 1))
        if seen < self.failures:
            raise OSError("connection lost")
        hours = -(-(end - start) // timedelta(hours=1))
        moments = [start + timedelta(hours=i) for i in range(hours)]
        moments = [m for m in moments if m < end]
        if len(moments) > self.cap:
            raise WindowTooLarge
        return [
            {
                "id": f"{m:%Y%m%d%H}",
                "properties": {"time": f"{m:%Y-%m-%dT%H:%M:%S}Z", "lat": 1.0, "mag": 3.0, "x": 1},
            }
            for m in moments
        ]


def event_time(document):
    return datetime.fromisoformat(document["time"])


def event_mag(document):
    return document["mag"]


class MagnitudeFetch:
    """One event every six hours of magnitudes 3 to 5.9; notes each request and its least magnitude."""

    def __init__(self, folder, least=None):
        self.folder, self.least = str(folder), least

    def at_least(self, magnitude):
        return MagnitudeFetch(self.folder, magnitude)

    def __call__(self, start, end):
        (Path(self.folder) / f"{start:%Y%m%d}_{self.least}").touch()
        moments = [start + timedelta(hours=6 * i) for i in range((end - start) // timedelta(hours=6))]
        events = [(m, 3 + (m.day * 4 + m.hour // 6) % 30 / 10) for m in moments]
        return [{"time": m.isoformat(), "mag": g} for m, g in events if self.least is None or g >= self.least]


class OutageFetch(FileFetch):
    """Does not answer for windows from ``moment`` on while the file ``down`` is in its folder."""

    def __init__(self, folder, moment):
        super().__init__(folder, cap=10_000)
        self.moment = moment

    def __call__(self, start, end):
        if start.replace(tzinfo=None) >= self.moment and (Path(self.folder) / "down").exists():
            raise OSError("no answer")
        return super().__call__(start, end)
