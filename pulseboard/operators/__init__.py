"""DataFrame operators shared by the silver, gold and report layers."""
