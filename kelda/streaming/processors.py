"""Keyed state of the streaming operators: what a bucket of keys does with its new rows.

Times are microseconds since 1970. Keys lie in buckets by hash, and a bucket's keys share one value in
the state store and one timer (see ``Keyed``). A processor sees a bucket's rows of one batch, after those
of the whole batch have been thinned out before the shuffle where that is possible (see ``thin``).
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MILLI, DAY_MILLIS = 1000, 86_400_000
#: A start without an answer so far.
OPEN = -(2**63)

GROUP = ("k0", "k1", "k2")
ANSWERED = Row(*GROUP, "a_id", "a_at", "b_at")
ALONE = Row(*GROUP, "a_id", "a_at")
FIRST = Row("key", "day", "at", "first_id", "is_first_ever")


def thin(by: Sequence[str], order: Sequence[str], last: bool = False) -> Callable:
    """For mapInArrow: of each batch's rows of a group the first by ``order``, or the last; nulls come first.

    A key with very many rows then sends one for each batch of rows, not all, to its task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            place = pa.compute.sort_indices(
                table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"
            )
            ranked = table.select(list(dict.fromkeys(by))).take(place).append_column("_place", place)
            picked = ranked.group_by(list(by), use_threads=False).aggregate([("_place", "last" if last else "first")])
            yield from table.take(picked.column(f"_place_{'last' if last else 'first'}")).combine_chunks().to_batches()

    return run


def _watermark(timers) -> int:
    return max(timers.getCurrentWatermarkInMs(), 0) * MILLI


def _same(value):
    """Equal and hashable for all values that Spark puts in one group."""
    if isinstance(value, float):
        return "NaN" if value != value else value
    if isinstance(value, (list, tuple)):
        return tuple(map(_same, value))
    return bytes(value) if isinstance(value, bytearray) else value


class Keyed(StatefulProcessor):
    """State by key, the keys of a bucket in one value: a batch reads and writes it once, however many
    keys there are in it. Calls of the state store and of timers by key would each be a way to the JVM and back.

    Rows begin with the ``by`` columns of their key. A subclass says what it keeps of a key's new rows
    (``new``, ``add``), what these do to the key's state (``step``), and what its time does (``expire``); both
    yield rows and return the state, None if there is nothing to keep. A state ends with the time (in
    milliseconds) from which ``expire`` is due, or None. The bucket has a timer for the earliest of these.
    """

    by = 1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("keys", "held binary, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[tuple, tuple] = {}
        for row in rows:
            name = tuple(row[: self.by])
            same = _same(name)
            if same not in fresh:
                fresh[same] = (name, self.new())
            self.add(fresh[same][1], row)
        mark = _watermark(timerValues)
        held, due = self._load()
        for same, (name, found) in fresh.items():
            _, before = held.get(same, (name, None))
            after = yield from self.step(name, before, found, mark)
            self._put(held, same, name, after)
        self._store(held, due, mark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = _watermark(timerValues)
        held, due = self._load()
        for same, (name, before) in list(held.items()):
            if before[-1] is not None and before[-1] * MILLI <= mark:
                after = yield from self.expire(name, before, mark)
                self._put(held, same, name, after)
        self._store(held, None if due is None or due <= expiredTimerInfo.getExpiryTimeInMs() else due, mark)

    def _load(self) -> tuple[dict, int | None]:
        found = self.state.get()
        return (pickle.loads(found[0]), found[1]) if found else ({}, None)

    def _put(self, held: dict, same: tuple, name: tuple, after: tuple | None) -> None:
        if after is not None:
            held[same] = (name, after)
        else:
            held.pop(same, None)

    def _store(self, held: dict, due: int | None, mark: int) -> None:
        if not held:
            self.state.clear()
            return
        least = min((s[-1] for _, s in held.values() if s[-1] is not None), default=None)
        if least is not None and (due is None or least < due or due * MILLI <= mark):
            self.handle.registerTimer(least)
            due = least
        self.state.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL), due))

    def new(self):
        return []

    def close(self) -> None:
        pass


class Answers(Keyed):
    """Starts of a group with the first answer that follows within ``within``.

    Rows are (group, starts, at, id). State holds the starts that can still get an answer or an earlier
    one, and the answers that a late start can still need: those the watermark has not passed. A
    start is written when its first answer is there, and again only if an earlier answer comes
    late. A group's time clears what the watermark has settled when no more rows come.
    """

    by = len(GROUP)

    def __init__(self, within: int) -> None:
        self.within = within

    def add(self, found: list, row: Row) -> None:
        found.append((row.starts, row.at, row.id))

    def step(self, key, held, rows, mark):
        at, ids, answer, seen, timer = held or ([], [], [], [], None)
        old, fresh = len(at), []
        for starts, when, id_ in rows:
            if starts:
                at.append(when)
                ids.append(id_)
                answer.append(OPEN)
            else:
                fresh.append(when)
        # Old starts look at new answers, new ones at all.
        fresh.sort()
        every = sorted(seen + fresh)
        for k, start in enumerate(at):
            own = fresh if k < old else every
            place = bisect_right(own, start)
            if place < len(own) and own[place] <= start + self.within and (answer[k] == OPEN or own[place] < answer[k]):
                answer[k] = own[place]
                yield ANSWERED(*key, ids[k], start, answer[k])
        return self._kept(at, ids, answer, every, timer, mark)

    def _kept(self, at, ids, answer, seen, timer, mark) -> tuple | None:
        """State without what the watermark has settled."""
        ends = [t + self.within if b == OPEN else b for t, b in zip(at, answer)]
        # An answer at the mark may still come, an earlier one than that at the mark not.
        rest = [k for k, b in enumerate(answer) if (ends[k] >= mark if b == OPEN else ends[k] > mark)]
        seen = [t for t in seen if t > mark]
        if not rest and not seen:
            return None
        if timer is None:
            timer = max([*(ends[k] for k in rest), *seen]) // MILLI + 1
        return [at[k] for k in rest], [ids[k] for k in rest], [answer[k] for k in rest], seen, timer

    def expire(self, key, held, mark):
        yield from ()
        return self._kept(*held[:-1], None, mark)


class Unanswered(Keyed):
    """Starts of a group that no answer follows within ``within``, each once the watermark has passed its own expiry.

    Rows are (group, starts, at, id). State holds the open starts, each until it is answered or expires, and the
    answers that a late start can still need. The time of a group is that of its first open start.
    """

    by = len(GROUP)

    def __init__(self, within: int) -> None:
        self.within = within

    def add(self, found: list, row: Row) -> None:
        found.append((row.starts, row.at, row.id))

    def step(self, key, held, rows, mark):
        at, ids, seen, timer = held or ([], [], [], None)
        for starts, when, id_ in rows:
            if starts:
                at.append(when)
                ids.append(id_)
            else:
                seen.append(when)
        seen.sort()
        rest = []
        for k, start in enumerate(at):
            place = bisect_right(seen, start)
            if place == len(seen) or seen[place] > start + self.within:
                rest.append(k)
        return (yield from self._settle(key, [at[k] for k in rest], [ids[k] for k in rest], seen, mark))

    def _settle(self, key, at, ids, seen, mark):
        rest = []
        for k, start in enumerate(at):
            # An answer at the mark may still come.
            if start + self.within < mark:
                yield ALONE(*key, ids[k], start)
            else:
                rest.append(k)
        seen = [t for t in seen if t > mark]
        if not rest and not seen:
            return None
        due = min([at[k] + self.within for k in rest], default=max(seen, default=0)) // MILLI + 1
        return [at[k] for k in rest], [ids[k] for k in rest], seen, due

    def expire(self, key, held, mark):
        return (yield from self._settle(key, *held[:-1], mark))


class FirstDays(Keyed):
    """A key's first event of each day, and whether the key was new or away for more than ``keep`` days.

    Rows are (key, day, at, id), days numbered from 1970. State holds the days that are known: all of them, or with
    ``keep`` those a later day can still be compared with. Then it goes when the watermark has
    passed the last day by so much that the key counts as new whatever comes.
    """

    def __init__(self, keep: int | None) -> None:
        self.keep = keep

    def new(self):
        return {}

    def add(self, found: dict, row: Row) -> None:
        place = (row.at, row.id is not None, row.id if row.id is not None else 0)
        if row.day not in found or place < found[row.day]:
            found[row.day] = place

    def step(self, key, held, firsts, mark):
        known, _ = held or ([], None)
        settled = set(known)
        least = known[-1] - self.keep - 1 if self.keep is not None and known else None
        for day in sorted(firsts):
            # Days that are no longer kept have been told.
            if day in settled or least is not None and day < least:
                continue
            before = max((d for d in known if d < day), default=None)
            away = before is None or self.keep is not None and day - before - 1 > self.keep
            at, has, id_ = firsts[day]
            yield FIRST(key[0], day, at, id_ if has else None, away)
            known.append(day)
        if not known:
            return None
        known.sort()
        if self.keep is None:
            return known, None
        return [d for d in known if d >= known[-1] - self.keep - 1], (known[-1] + self.keep + 2) * DAY_MILLIS

    def expire(self, key, held, mark):
        yield from ()


class Versions(Keyed):
    """Events of a group with the version that holds at their time, each once the watermark has passed it.

    Rows are (key, salt, at, tie, event), then the columns of an event and those of a version. State
    holds the events that wait, the versions from the watermark on, and the last one before it with the
    time since when nothing has changed. Events without a key or a time wait for nothing.
    """

    by = 2

    def __init__(self, columns: Sequence[str], events: int, versions: int) -> None:
        self.columns, self.events, self.versions = list(columns), events, versions

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.out = Row(*self.columns)

    def new(self):
        return [], [], []

    def add(self, found: tuple, row: Row) -> None:
        changed, asked, lost = found
        border = 5 + self.events
        if not row[4]:
            changed.append((row[2], row[3], tuple(row[border : border + self.versions]), None))
        elif row[0] is None or row[2] is None:
            lost.append(tuple(row[5:border]))
        else:
            asked.append((row[2], tuple(row[5:border])))

    def step(self, key, held, rows, mark):
        changes, waiting, due = held or ([], [], None)
        changed, asked, lost = rows
        for event in lost:
            yield self._shown(event, None, None)
        least = min((at for at, _ in asked), default=mark)
        if changed and due is not None:
            # Events that wait may need all there is; what they do not is dropped when they go.
            changes = changes + changed
        elif changed:
            changes = self._kept(changes + changed, min(least, mark))
        if asked:
            changes, waiting, due = yield from self._settle(changes, waiting + asked, least, mark, due)
        return (changes, waiting, due) if changes or waiting else None

    def _shown(self, event: tuple, version: tuple | None, since: int | None) -> Row:
        return self.out(*event, *(version or (None,) * self.versions), since)

    def _settle(self, changes: list[tuple], waiting: list[tuple], least: int, mark: int, before: int | None):
        """Events before the mark, if there can be any; the first of the others says when it goes on."""
        due = least // MILLI + 1
        if least < mark:
            runs = self._runs(changes)
            times = [c[0] for c in runs]
            for at, event in waiting:
                if at < mark:
                    place = bisect_right(times, at) - 1
                    found = runs[place] if place >= 0 else None
                    yield self._shown(event, found[2] if found else None, found[3] if found else None)
            waiting = [e for e in waiting if e[0] >= mark]
            changes = self._kept(runs, mark)
            if not waiting:
                return changes, waiting, None
            due = min(at for at, _ in waiting) // MILLI + 1
        return changes, waiting, due if before is None or due < before or before * MILLI <= mark else before

    def _runs(self, changes: list[tuple]) -> list[tuple]:
        """Versions by time, of those at one time the last by ``tie``, and since when each one's columns are as they are."""
        age = lambda c: (c[0], c[3] is None, c[1] is not None, c[1] if c[1] is not None else 0)
        found: list[tuple] = []
        for at, tie, row, since in sorted(changes, key=age):
            if found and found[-1][0] == at:
                found.pop()
            if since is None:
                since = found[-1][3] if found and found[-1][2] == row else at
            found.append((at, tie, row, since))
        return found

    def _kept(self, changes: list[tuple], least: int) -> list[tuple]:
        """Without the versions that hold for no event at ``least`` or later."""
        runs = self._runs(changes)
        first = max(bisect_right([c[0] for c in runs], least - 1) - 1, 0)
        # Only what is behind is settled: a change may still come between two others.
        return [c if c[0] < least else (*c[:3], None) for c in runs[first:]]

    def expire(self, key, held, mark):
        changes, waiting, due = held
        changes, waiting, due = yield from self._settle(changes, waiting, (due - 1) * MILLI, mark, due)
        return (changes, waiting, due) if changes or waiting else None


class Newest(StatefulProcessor):
    """Rows that are newer than all their key had before.

    Rows have a sequence and ``gone``, whether they delete. State is the newest sequence of a key; that of
    a deleted key expires ``ttl`` milliseconds later, that of others never.
    """

    def __init__(self, seq: str, gone: str, seq_type: str, ttl: int) -> None:
        self.seq, self.gone, self.seq_type, self.ttl = seq, gone, seq_type, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("live", f"seq {self.seq_type}")
        self.deleted = handle.getValueState("deleted", f"seq {self.seq_type}", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # A null is the oldest.
        age = lambda seq: (seq is not None, seq if seq is not None else 0)
        best = max(rows, key=lambda r: age(r[self.seq]))
        live, deleted = self.live.get(), self.deleted.get()
        before = live or deleted
        if before and age(best[self.seq]) <= age(before[0]):
            return
        gone = best[self.gone]
        (self.deleted if gone else self.live).update((best[self.seq],))
        if live and gone:
            self.live.clear()
        if deleted and not gone:
            self.deleted.clear()
        yield best

    def close(self) -> None:
        pass
