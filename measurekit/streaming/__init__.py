"""The row-wise rules and fitted models applied to streaming frames."""
