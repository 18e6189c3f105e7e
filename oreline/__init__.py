"""Change-data-capture streams -> bronze log -> silver state -> gold report."""
