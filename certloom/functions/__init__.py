"""Pure ``Column -> Column`` scalar functions."""
