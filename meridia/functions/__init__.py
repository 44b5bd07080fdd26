"""Part of the library; see the package."""
