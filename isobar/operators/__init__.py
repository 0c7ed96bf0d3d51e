"""DataFrame -> DataFrame operators over forecast fields."""
