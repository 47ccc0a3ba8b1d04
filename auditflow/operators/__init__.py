"""DataFrame operators: joins, windows, reports, validators, state machines."""
