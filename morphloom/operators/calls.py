"""Calls of an annotator from threads of their own: several at once, each with a deadline."""

from __future__ import annotations

import threading
import time
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from queue import Empty, SimpleQueue

# Calls of one task that may be left hanging in a row, with no answer in between.
MAX_HANGING = 32
# Bytes of answers, and of their texts, kept behind one that is waited for; beyond the first
# ones, answers are compressed.
AHEAD_BYTES = 64_000_000
_PLAIN_BYTES = 8_000_000
_CALL_BYTES = 500  # what a call takes besides


class _Call:
    def __init__(self, wire: str | None):
        self.wire = wire
        self.started: float | None = None  # when the annotator was called, once it is set up
        self.answer = self.error = self.no_annotator = None
        self.result: tuple | None = None
        self.packed = False
        # The text lies in its batch until the answer is handed on.
        self.text_size = _CALL_BYTES + len(wire or "")
        self.size = 0


def _serve(factory: Callable, calls: SimpleQueue, ended: SimpleQueue) -> None:
    annotator = None
    while (call := calls.get()) is not None:
        try:
            if annotator is None:
                annotator = factory()
        except Exception as exc:
            call.no_annotator = exc
        else:
            call.started = time.monotonic()
            try:
                call.answer = annotator(call.wire)
            except Exception as exc:
                call.error = exc
        ended.put(call)


class Calls:
    """Up to ``in_flight`` calls at once, each from a thread with an annotator of its own.

    A call that has no answer after ``deadline`` seconds is given up: it counts as failed
    with a ``TimeoutError``, and its thread, which cannot be stopped, is replaced by a new
    one. Until then it holds its own place only: other calls go on, and their answers are
    kept, up to ``AHEAD_BYTES``, until it is their turn. When ``MAX_HANGING`` in a row are
    left behind the task fails, since the annotator is dead.
    """

    def __init__(self, factory: Callable, in_flight: int, deadline: float | None):
        self.factory, self.in_flight, self.deadline = factory, in_flight, deadline
        self.free: list[SimpleQueue] = []
        self.ended: SimpleQueue = SimpleQueue()
        self.running: dict[_Call, SimpleQueue] = {}
        self.hanging = 0
        self.kept = 0

    def _thread(self) -> SimpleQueue:
        calls: SimpleQueue = SimpleQueue()
        # A daemon, so that a call that hangs does not keep the worker process alive.
        threading.Thread(target=_serve, args=(self.factory, calls, self.ended), daemon=True).start()
        return calls

    def _give_up(self) -> bool:
        """Whether a running call was past its deadline."""
        late = [
            call
            for call in self.running
            if call.started is not None and time.monotonic() >= call.started + self.deadline
        ]
        for call in late:
            self.hanging += 1
            if self.hanging > MAX_HANGING:
                raise RuntimeError(f"{self.hanging} calls of the annotator hang")
            self.running.pop(call).put(None)  # should the call ever end, so does its thread
            self._end(call, None, TimeoutError(f"no answer within {self.deadline:g} s"))
        return bool(late)

    def _left(self) -> float | None:
        """Seconds until the next deadline."""
        if self.deadline is None:
            return None
        # A call without a start is one whose annotator is being set up, which takes its time.
        starts = [call.started for call in list(self.running)]
        left = [s + self.deadline - time.monotonic() for s in starts if s is not None]
        return max(0.0, min([*left, *([0.05] if None in starts else [])]))

    def _end(self, call: _Call, answer, error: Exception | None) -> None:
        call.size = call.text_size + (len(answer) if isinstance(answer, (str, bytes)) else 0)
        self.kept += call.size
        call.result, call.wire = (answer, error), None

    def _settle(self) -> None:
        """Wait until a running call has ended or is given up."""
        while True:
            try:
                call = self.ended.get(timeout=self._left())
            except Empty:
                if self._give_up():
                    return
                continue
            if call not in self.running:  # given up before
                continue
            self.free.append(self.running.pop(call))
            if call.no_annotator is not None:
                raise call.no_annotator
            self.hanging = 0
            answer = call.answer
            if isinstance(answer, str) and self.kept > _PLAIN_BYTES:
                answer = zlib.compress(answer.encode(errors="surrogatepass"), 1)
                call.packed = True
            self._end(call, answer, call.error)
            call.answer = None
            if self.deadline is not None:
                self._give_up()
            return

    def answers(self, wires: Iterable[str | None]) -> Iterator[tuple]:
        """(answer, error) of each text, in their order; neither for None."""
        turn: deque[_Call] = deque()

        def ready():
            while turn and turn[0].result is not None:
                call = turn.popleft()
                answer, error = call.result
                self.kept -= call.size
                if call.packed:
                    answer = zlib.decompress(answer).decode(errors="surrogatepass")
                yield answer, error

        for wire in wires:
            while self.running and (len(self.running) >= self.in_flight or self.kept > AHEAD_BYTES):
                self._settle()
                yield from ready()
            call = _Call(wire)
            turn.append(call)
            if wire is None:
                self._end(call, None, None)
            else:
                self.running[call] = self.free.pop() if self.free else self._thread()
                self.running[call].put(call)
            yield from ready()
        while turn:
            self._settle()
            yield from ready()

    def close(self) -> None:
        for calls in self.free:
            calls.put(None)


class DirectCalls:
    """One call after the other, in the task's own thread, however long each takes."""

    def __init__(self, factory: Callable):
        self.factory, self.annotator = factory, None

    def answers(self, wires: Iterable[str | None]) -> Iterator[tuple]:
        for wire in wires:
            if self.annotator is None:
                self.annotator = self.factory()
            if wire is None:
                yield None, None
                continue
            try:
                yield self.annotator(wire), None
            except Exception as exc:
                yield None, exc

    def close(self) -> None:
        pass
