"""Where chain tables come from and where they are kept."""
