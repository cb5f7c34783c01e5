"""Launcher for spark-submit; the package comes along as a zip or lies beside this file."""

from scriptorium.__main__ import main

if __name__ == "__main__":
    main()
