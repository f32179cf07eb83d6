"""Column helpers (``exprs``) and keyed building blocks (``keyed``, ``pairs``, ``asof``)."""
