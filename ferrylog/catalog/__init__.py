"""One query per operator over the ``events`` mapping, and its SQL check."""
