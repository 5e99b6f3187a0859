"""Rule parameters of the reading view over ``events`` (FIXTURES.md section 3).

The reference's own constants stay the defaults in ``operators.clean``; the
fixture view uses its own values so that every rule has rows to act on.
"""

from __future__ import annotations

from terrarium.operators.clean import CapRule, RetireRule

LO = 200.0
HI = 10000.0
MAX_STDDEV = 200.0
CAPS = (CapRule("click", 500.0),)
RETIRES = (RetireRule("view", "2024-01-20"),)

# Signing key for payloads derived from events, and a second key standing in
# for a device that signs with the wrong one.  Invented values.
SIGNING_KEY = "fixture-signing-key"
WRONG_KEY = "some-other-key"

DIGITS = 6  # doubles are rounded to this many digits on both sides
